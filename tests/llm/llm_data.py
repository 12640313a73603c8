"""Invented texts for the tests of this folder."""

import random


def prose(seed: int, words: int) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choice(["ta", "ri", "mo", "ne", "lu", "so", "ki"]) for _ in range(pick.randint(1, 4)))
            for _ in range(words)]


def sorted_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
