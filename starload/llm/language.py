"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 in segments of SEGMENT bytes, forwards and backwards from
a zero state, and gives every byte the probabilities of the languages.  A
document's probabilities are the means over the bytes of its letters.  Gates and
candidates are piecewise linear (clipped), which keeps a step to a few array
operations over many segments at once.  The weights are fitted by
backpropagation through time on a bounded sample of the documents of every
language; the segments that are learnt from are drawn from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starload.llm.common import fold, held_out, shared, utf8
from starload.scratch import materialise

#: The bounds of the sample: documents of a language, and segments of a language out of those of their whole texts.
EXAMPLES = 1_000
SEGMENTS = 16_384
SEGMENT = 128
HIDDEN = 10
STEPS = 240
BATCH = 256
RATE = 0.02
SEED = 3
UNKNOWN = "und"
#: Segments that go through the network at once.
TOGETHER = 2048
RESULT = "lang_pred string, score double"


def segments_of(data: bytes) -> np.ndarray:
    """The bytes in rows of SEGMENT, the last one filled up with zeros."""
    return np.frombuffer(data + bytes(-len(data) % SEGMENT), dtype=np.uint8).reshape(-1, SEGMENT)


def letters_in(segments: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters: ASCII letters and everything beyond ASCII."""
    small = segments | 0x20
    return ((small >= 97) & (small <= 122)) | (segments >= 128)


@dataclass
class Direction:
    """One direction: input weights by byte, recurrent weights of the gates and of the candidate."""

    inputs: np.ndarray  # 256 x 3 hidden: update, reset, candidate
    gates: np.ndarray  # hidden x 2 hidden
    candidate: np.ndarray  # hidden x hidden

    def states(self, data: np.ndarray, backwards: bool, trace: list | None = None) -> np.ndarray:
        """The states at all places of time-major data; with `trace`, what the backward pass needs."""
        steps, width, hidden = *data.shape, self.candidate.shape[0]
        every = np.empty((steps, width, hidden), np.float32)
        state = np.zeros((width, hidden), np.float32)
        for t in (range(steps - 1, -1, -1) if backwards else range(steps)):
            given = self.inputs[data[t]]
            opened = given[:, :2 * hidden] + state @ self.gates
            opened *= 0.25
            opened += 0.5
            gate = np.clip(opened, 0.0, 1.0)
            update, reset = gate[:, :hidden], gate[:, hidden:]
            raw = given[:, 2 * hidden:] + (reset * state) @ self.candidate
            new = np.clip(raw, -1.0, 1.0)
            following = state + update * (new - state)
            if backwards:  # the state begins where the text ends
                following *= (data[t] > 0)[:, None]
            if trace is not None:
                trace.append((t, state, opened, gate, raw, new))
            state = following
            every[t] = state
        return every

    def gradients(self, data: np.ndarray, backwards: bool, trace: list, outer: np.ndarray) -> list[np.ndarray]:
        hidden = self.candidate.shape[0]
        d_inputs, d_gates, d_candidate = (np.zeros_like(x) for x in (self.inputs, self.gates, self.candidate))
        carried = np.zeros_like(outer[0])
        for t, state, opened, gate, raw, new in reversed(trace):
            total = outer[t] + carried
            if backwards:
                total = total * (data[t] > 0)[:, None]
            update, reset = gate[:, :hidden], gate[:, hidden:]
            d_raw = total * update * (np.abs(raw) < 1)
            d_reset_state = d_raw @ self.candidate.T
            d_gate = np.concatenate([total * (new - state), d_reset_state * state], axis=1)
            d_opened = 0.25 * d_gate * ((opened > 0) & (opened < 1))
            carried = total * (1 - update) + d_reset_state * reset + d_opened @ self.gates.T
            d_gates += state.T @ d_opened
            d_candidate += (reset * state).T @ d_raw
            np.add.at(d_inputs, data[t], np.concatenate([d_opened, d_raw], axis=1))
        return [d_inputs, d_gates, d_candidate]


@dataclass
class Network:
    """Both directions and the output layer, for the languages in their order."""

    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # 2 hidden x languages
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.gates, self.forward.candidate, self.backward.inputs,
                self.backward.gates, self.backward.candidate, self.output, self.bias]

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """steps x segments x languages."""
        hidden = self.forward.candidate.shape[0]
        scores = self.forward.states(data, False) @ self.output[:hidden]
        scores += self.backward.states(data, True) @ self.output[hidden:]
        scores += self.bias
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=2, keepdims=True)

    def learn(self, data: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over the counted places (steps x segments)."""
        hidden, traces = self.forward.candidate.shape[0], ([], [])
        both = np.concatenate([self.forward.states(data, False, traces[0]),
                               self.backward.states(data, True, traces[1])], axis=2)
        scores = both @ self.output + self.bias
        scores -= scores.max(axis=2, keepdims=True)
        error = np.exp(scores)
        error /= error.sum(axis=2, keepdims=True)
        error[:, np.arange(data.shape[1]), labels] -= 1
        error *= (counts / max(1, counts.sum()))[:, :, None]
        error = error.astype(np.float32)
        outer = error @ self.output.T
        flat = error.reshape(-1, error.shape[2])
        return [*self.forward.gradients(data, False, traces[0], outer[:, :, :hidden]),
                *self.backward.gradients(data, True, traces[1], outer[:, :, hidden:]),
                both.reshape(-1, both.shape[2]).T @ flat, flat.sum(axis=0)]

    def pooled(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, mean probability) of each text; `und` for a text without letters."""
        data = [utf8(t) for t in texts]
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        start, waiting, owners = 0, [], []

        def flush():
            segments, owner = np.concatenate(waiting), np.concatenate(owners)
            for i in range(0, len(segments), TOGETHER):
                part = np.ascontiguousarray(segments[i:i + TOGETHER].T)
                counted = letters_in(part)
                chances = self.probabilities(part)
                np.add.at(sums, owner[i:i + TOGETHER], np.einsum("tsl,ts->sl", chances, counted.astype(np.float32)))
                np.add.at(counts, owner[i:i + TOGETHER], counted.sum(axis=0))
            waiting.clear()
            owners.clear()

        for i, one in enumerate(data):
            if one:
                waiting.append(segments_of(one))
                owners.append(np.full(len(waiting[-1]), i))
                start += len(waiting[-1])
                if start >= TOGETHER:
                    flush()
                    start = 0
        if waiting:
            flush()
        results = []
        for i, text in enumerate(texts):
            if not text or not counts[i] or not any(map(str.isalpha, text)):
                results.append((UNKNOWN, 0.0))
            else:
                mean = sums[i] / counts[i]
                best = int(mean.argmax())
                results.append((self.languages[best], float(min(1.0, mean[best]))))
        return results


def train(texts: list[bytes], labels: list[str]) -> Network | None:
    """A network fitted with Adam on segments drawn with equal weight per language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    random = np.random.default_rng(SEED)
    small = lambda *shape: (random.standard_normal(shape) * 0.2).astype(np.float32)
    directions = [Direction(small(256, 3 * HIDDEN), small(HIDDEN, 2 * HIDDEN), small(HIDDEN, HIDDEN)) for _ in range(2)]
    for one in directions:  # gates begin half open, on the side of keeping the state
        one.inputs[:, :HIDDEN] -= 1.0
    network = Network(languages, *directions, small(2 * HIDDEN, len(languages)), np.zeros(len(languages), np.float32))
    rows, owners = [], []
    for text, label in zip(texts, labels):
        if text:
            rows.append(segments_of(text))
            owners.append(np.full(len(rows[-1]), languages.index(label)))
    if not rows:
        return network
    segments, owner = np.concatenate(rows), np.concatenate(owners)
    weight = 1.0 / np.bincount(owner, minlength=len(languages))[owner]
    weight /= weight.sum()
    values = network.parameters()
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        chosen = random.choice(len(segments), BATCH, p=weight)
        data = np.ascontiguousarray(segments[chosen].T)
        rate = RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1)))
        for value, gradient, m, v in zip(values, network.learn(data, letters_in(data), owner[chosen]), first, second):
            gradient = np.clip(gradient, -1, 1)
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient * gradient - v)
            value -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return network


def learnt_rows(docs: DataFrame, usable: Column, bound: int = EXAMPLES) -> DataFrame:
    """(doc_id, text, lang): at most `bound` rows of every language, the same ones in every run; equal rows count once."""
    order = F.xxhash64("doc_id", "text", F.lit(SEED))
    known = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & usable)
             .select("doc_id", "text", "lang", order.alias("order")))
    first = Window.partitionBy("lang").orderBy("order")
    last = (known.select("lang", "order").distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= bound)
            .groupBy("lang").agg(F.max("order").alias("last")))
    # One row per language, of which the network has an output each: no text moves to find the sample.
    return materialise(known.join(F.broadcast(last), "lang").where(F.col("order") <= F.col("last")).dropDuplicates(["lang", "order"])
                       .drop("last"), "learnt")


def learnt_segments(rows: DataFrame, bound: int = SEGMENTS) -> DataFrame:
    """(lang, data): segments of whole texts, at most `bound` of a language; each has the same chance to be among them."""
    data = F.col("text").cast("binary")
    number = F.ceil(F.length(data) / SEGMENT).cast("int")
    places = rows.where(F.length(data) > 0).select("lang", "order", data.alias("data"),
                                                   F.explode(F.sequence(F.lit(0), number - 1)).alias("place"))
    cut = places.select("lang", F.substring("data", F.col("place") * SEGMENT + 1, F.lit(SEGMENT)).alias("data"),
                        F.xxhash64("order", "place").alias("order"))
    first = Window.partitionBy("lang").orderBy("order", "data")
    return cut.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= bound).select("lang", "rank", "data")


def fit(docs: DataFrame, usable: Column, bound: int = EXAMPLES) -> Network | None:
    """A network for the languages of a bounded sample of every language's documents."""
    rows = learnt_segments(learnt_rows(docs, usable, bound)).orderBy("lang", "rank").toPandas()
    return train([bytes(x) for x in rows["data"]], rows["lang"].tolist())


def predicted(text: Column, network: Network | None, spark: SparkSession) -> Column:
    unpack = shared(spark, network)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = unpack()
        for texts in batches:
            rows = known.pooled(list(texts)) if known else [(UNKNOWN, 0.0)] * len(texts)
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])
    return predict(text)


def identified(docs: DataFrame, folds: int = 5, remainder: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of docs (doc_id, text, lang and any others).

    Learnt from rows with text and lang whose fold is not the held-out one, each by
    its own lang, also where rows share a doc_id; equal rows count once.  A row
    without doc_id is not learnt from and not held out.  A NULL text, an empty
    one and one without letters have `und` and score 0, as all rows have if there
    is nothing to learn from.  An empty table gives an empty one.
    """
    network = fit(docs, fold("doc_id", folds) != remainder)
    return docs.select("doc_id", held_out("doc_id", folds, remainder).alias("held_out"),
                       predicted(F.col("text"), network, docs.sparkSession).alias("p")).select("doc_id", "held_out", "p.*")
