"""Tables whose loads are folders of their own, shown by one view.

The rows lie in `<table>__files`, partitioned by the table's own partition columns
and by the number of the load that wrote them; nothing that a load wrote is ever changed.  The table
itself is a view over it that says which loads count for which partitions.  A load
writes its files, and then one CREATE OR REPLACE VIEW makes all of them visible
and all rows that they replace invisible: readers see the rows before or after,
however many partitions it touched, and a load that is lost before leaves nothing behind that is seen.  All
conditions are on partition columns, so a read lists only the folders that count.

The state is kept as properties of the view: it grows with the partitions that were replaced since
the last `vacuum`, which deletes what is not seen any more.  One load writes a table at a time.
"""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame, functions as F

from starload.scratch import remove
from starload.spec import IS_CURRENT, VALID_TO, ColumnSpec, TableSpec, comment

if TYPE_CHECKING:
    from starload.sources.warehouse import Warehouse

FILES = "__files"
# Hidden partition columns, the value of open versions, and how Spark writes a NULL partition.
LOAD, CLOSED, OPEN = "_load", "_closed", "open"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PROPERTY, CHUNK = "starload.state", 3000
#: A run can be repeated as long as it is among so many last ones of its table.
RUNS = 100


@dataclass
class State:
    """Which loads count: up to `committed`, from `base` on, none of `hidden`; partitions only `since` a load."""

    committed: int = 0
    attempt: int = 0
    base: int = 0
    hidden: list[int] = field(default_factory=list)
    since: list[tuple[dict[str, str | None], int]] = field(default_factory=list)
    runs: dict[str, int] = field(default_factory=dict)

    def next(self, *, everything: bool, replaced: Sequence[dict[str, str | None]], run: str | None) -> State:
        """The state once the next load is there."""
        number = max(self.committed, self.attempt) + 1
        hidden = list(self.hidden)
        if self.attempt > self.committed:  # begun and never ended
            hidden.append(self.attempt)
        if run in self.runs:  # a repeated run takes the place of its own rows
            hidden.append(self.runs[run])
        since = [(p, n) for p, n in self.since if p not in replaced] + [(p, number) for p in replaced]
        runs = {r: n for r, n in self.runs.items() if r != run} | ({run: number} if run else {})
        runs = dict(sorted(runs.items(), key=lambda r: r[1])[-RUNS:])
        if everything:
            return State(number, number, number, [], [], runs)
        return State(number, number, self.base, sorted(hidden), since, runs)

    def counts(self, partition: dict[str, str | None]) -> bool:
        """Whether a partition (with its load) is seen."""
        load = int(partition[LOAD] or 0)
        return (self.base <= load <= self.committed and load not in self.hidden
                and not any(load < n and p.items() <= partition.items() for p, n in self.since))


class VersionedTable:
    def __init__(self, warehouse: Warehouse, spec: TableSpec) -> None:
        self.warehouse, self.spec, self.spark = warehouse, spec, warehouse.spark
        self.view = warehouse.name(spec)
        self.files_name = f"{spec.full_name}{FILES}"
        self.files = warehouse.name(self.files_name)

    def exists(self) -> bool:
        return self.warehouse.exists(self.files_name)

    def create(self, *, versions: bool = False) -> None:
        """versions: the table has versions, which lie by whether they are open or by the month in which they ended."""
        more = (ColumnSpec(CLOSED, "TEXT"),) * versions + (ColumnSpec(LOAD, "INT"),)
        files = replace(self.spec, name=f"{self.spec.name}{FILES}", columns=(*self.spec.columns, *more),
                        partition_by=(*self.spec.partition_by, *(c.name for c in more)))
        self.warehouse.create_files(self.files, files, self._root())
        self._show(State())

    def has_versions(self) -> bool:
        return CLOSED in self.spark.table(self.files).columns

    # --- reading

    def state(self) -> State:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.view}").collect()}
        chunks = [found[k] for k in sorted((k for k in found if k.startswith(f"{PROPERTY}.")),
                                           key=lambda k: int(k.rpartition(".")[2]))]
        state = State(**json.loads("".join(chunks)))
        state.attempt = int(found.get(f"{PROPERTY}-attempt", state.attempt))
        state.since = [(p, n) for p, n in state.since]
        return state

    def rows(self, *, without_run: str | None = None, open_only: bool = False) -> DataFrame:
        """The table's rows, read from the files; without those of a run, or only versions that are open."""
        state = self.state()
        df = self.spark.table(self.files).where(self._condition(state))
        if without_run in state.runs:
            df = df.where(F.col(LOAD) != state.runs[without_run])
        if open_only:
            df = df.where(F.col(CLOSED) == OPEN)
        return df.select(*[c.name for c in self.spec.columns])

    # --- writing

    def write(self, df: DataFrame, *, replaced: Sequence[dict[str, Any]] = (), everything: bool = False,
              run: str | None = None) -> int:
        """Add df as a load; the partitions `replaced` (column -> value, some or all columns) lose their earlier rows.

        df may read the table itself.  Returns the number of rows written.
        """
        gone = list({json.dumps(p): p for p in ({c: None if v is None else _text(v) for c, v in r.items()}
                                                for r in replaced)}.values())
        state = self.state().next(everything=everything, replaced=gone, run=run)
        self.spark.sql(f"ALTER VIEW {self.view} SET TBLPROPERTIES ('{PROPERTY}-attempt' = '{state.attempt}')")
        if self.has_versions():
            month = F.coalesce(F.date_format(VALID_TO, "yyyy-MM"), F.lit("never"))
            df = df.withColumn(CLOSED, F.when(F.coalesce(F.col(IS_CURRENT), F.lit(False)), OPEN).otherwise(month))
        rows = self.warehouse.insert(self.files, df.withColumn(LOAD, F.lit(state.committed)), self.spec)
        self._show(state)
        return rows

    def vacuum(self) -> int:
        """Delete the folders that are not seen; returns their number.  For when nobody reads or writes the table."""
        state = self.state()
        shown = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.files}").collect()]
        dead = [p for p in shown if not state.counts(_partition(p))]
        if dead:
            dropped = ", ".join("PARTITION (" + ", ".join(
                f"`{c}` = {_literal(v)}" for c, v in _partition(p).items()) + ")" for p in dead)
            self.spark.sql(f"ALTER TABLE {self.files} DROP IF EXISTS {dropped}")
            remove(self.spark, [f"{self._root()}/{p}" for p in dead])
        state.hidden, state.since, state.attempt = [], [], state.committed
        self._show(state)
        return len(dead)

    def partitions(self) -> list[dict[str, str | None]]:
        """The partitions that are seen, with all their columns."""
        state = self.state()
        shown = [_partition(r[0]) for r in self.spark.sql(f"SHOW PARTITIONS {self.files}").collect()]
        return [p for p in shown if state.counts(p)]

    # --- helpers

    def _root(self) -> str:
        return f"{self.warehouse.root}/{self.spec.namespace}/{self.spec.name}{FILES}"

    def _condition(self, state: State) -> Column:
        return F.expr(self._predicate(state))

    def _predicate(self, state: State) -> str:
        types = {f.name: f.dataType.simpleString() for f in self.spark.table(self.files).schema}
        parts = [f"`{LOAD}` BETWEEN {state.base} AND {state.committed}"]
        if state.hidden:
            parts.append(f"`{LOAD}` NOT IN ({', '.join(map(str, state.hidden))})")
        by_load: dict[int, list[dict[str, str | None]]] = {}
        for partition, number in state.since:
            by_load.setdefault(number, []).append(partition)
        for number, gone in by_load.items():
            parts.append(f"(`{LOAD}` >= {number} OR NOT ({_any_of(gone, types)}))")
        return " AND ".join(parts)

    def _show(self, state: State) -> None:
        """The one change that readers see."""
        told = json.dumps({k: v for k, v in vars(state).items()})
        chunks = {f"{PROPERTY}.{i // CHUNK}": told[i:i + CHUNK] for i in range(0, len(told), CHUNK)}
        properties = ", ".join(f"'{k}' = {_literal(v)}" for k, v in chunks.items())
        columns = ", ".join(f"`{c.name}`{comment(c.description)}" for c in self.spec.columns)
        names = ", ".join(f"`{c.name}`" for c in self.spec.columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} ({columns}){comment(self.spec.description)}"
                       f" TBLPROPERTIES ({properties}) AS SELECT {names} FROM {self.files} WHERE {self._predicate(state)}")


def _any_of(partitions: Sequence[dict[str, str | None]], types: dict[str, str]) -> str:
    """SQL for being one of the partitions; never NULL."""
    def value(c: str, v: str | None) -> str:
        return f"CAST({_literal(v)} AS {types[c]})"

    conditions, lists = [], {}
    for p in partitions:
        if len(p) == 1 and None not in p.values():
            (c, v), = p.items()
            lists.setdefault(c, []).append(value(c, v))
        else:
            conditions.append("(" + " AND ".join(f"`{c}` <=> {value(c, v)}" for c, v in p.items()) + ")")
    return " OR ".join(conditions + [f"coalesce(`{c}` IN ({', '.join(v)}), false)" for c, v in lists.items()])


def _partition(shown: str) -> dict[str, str | None]:
    """`a=1/b=x` of SHOW PARTITIONS as a dictionary."""
    pairs = (part.partition("=") for part in shown.split("/"))
    return {urllib.parse.unquote(c): None if v == NULL_PARTITION else urllib.parse.unquote(v) for c, _, v in pairs}


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
