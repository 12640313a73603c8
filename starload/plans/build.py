"""One build spec as DataFrame transformations.

`stage` maps source rows to staged rows; written down, `resolve` makes target
rows of them.  Rows with generated keys have to be written in between, because
their positions are only fixed then.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from starload import spec as S
from starload.functions import library as lib
from starload.functions.registry import FunctionRegistry
from starload.operators.keys import highest, number_positions, position_rows
from starload.operators.lookup import lookup, lookup_as_of
from starload.operators.skew import HOT_ROWS, LOOK, PLACE, dealt_join, hot_keys_of_all, planned_small
from starload.scratch import materialise

_NUMBER = "_number"


def _order_column(i: int) -> str:
    return f"_order_{i}"


def lookup_column(mapping: S.ColumnMapping, i: int) -> str:
    """Name of the staged natural key column number i of a LOOKUP mapping."""
    return f"_{mapping.target_column}_nk{i}"


def _lookup_moment(mapping: S.ColumnMapping) -> str:
    return f"_{mapping.target_column}_at"


class Mapper:
    """Compiles the mappings of one build spec to Columns over its joined sources."""

    def __init__(self, spec: S.BuildSpec, registry: FunctionRegistry | None = None,
                 run_timestamp: datetime.datetime | None = None) -> None:
        self.spec = spec
        self.registry = registry or FunctionRegistry()
        self.run_timestamp = run_timestamp

    def source(self, name: str, table: str | None = None) -> Column:
        if name == S.RUN_TIMESTAMP:
            if self.run_timestamp is None:
                return F.localtimestamp()
            return F.lit(self.run_timestamp.isoformat(" ")).cast("timestamp_ntz")
        qualified = "." in name or (table is None and not self.spec.joins)
        return F.col(name) if qualified else F.col(f"{_alias(table or self.spec.base_table)}.{name}")

    def call(self, call: S.Call, table: str | None = None) -> Column:
        arguments = [self.call(a, table) if isinstance(a, S.Call) else self.source(a, table)
                     for a in call.arguments]
        return self.registry.call(call.function, *arguments)

    def expression(self, m: S.ColumnMapping) -> Column:
        """The value of a mapping that needs nothing but its own source row."""
        sources = [self.source(c, m.source_table) for c in m.source_columns]
        if m.transformation == S.DIRECT:
            value = sources[0]
        elif m.transformation == S.EXPRESSION:
            value = F.expr(m.expression)
        elif m.transformation == S.UDF:
            value = (self.call(m.udf, m.source_table) if isinstance(m.udf, S.Call)
                     else self.registry.call(m.udf, *sources))
        elif m.transformation == S.CONSTANT:
            value = self.source(m.value) if m.value == S.RUN_TIMESTAMP else F.lit(m.value)
        elif m.transformation == S.DEFAULT:
            value = F.coalesce(*sources, F.lit(m.value))
        elif m.transformation == S.UUID:
            value = lib.key_uuid(*sources)
        else:
            raise S.SpecError(f"{m.target_column}: {m.transformation} is not a row expression")
        return self.typed(value, m)

    def typed(self, value: Column, m: S.ColumnMapping) -> Column:
        """Cast to the declared type; a bad value fails the job unless the mapping says try_cast."""
        wanted = self.spec.target.column(m.target_column).spark_type
        return value.try_cast(wanted) if m.try_cast else value.cast(wanted)


def _alias(table: str) -> str:
    return table.rpartition(".")[2]


def joined_sources(spec: S.BuildSpec, sources: Mapping[str, DataFrame], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Base table, joins and filters of a spec; columns can be qualified by table name.

    Joins on columns of the base table that Spark would shuffle have the rows of hot keys
    dealt to several tasks; the hot keys of all of them come from one sampled count.
    """
    base = sources[spec.base_table]
    df, own = base.alias(_alias(spec.base_table)), _alias(spec.base_table).lower()
    keys = {}
    for i, j in enumerate(spec.joins):
        columns = [one[1] for one, _ in j.equalities if one[0].lower() == own]
        if (hot_rows is not None and j.how in ("left", "inner", "left_outer") and len(columns) == len(j.equalities)
                and not planned_small(sources[j.table])):
            keys[i] = columns
    hot = dict(zip(keys, hot_keys_of_all(base, list(keys.values()), hot_rows))) if keys else {}
    for i, j in enumerate(spec.joins):
        other = sources[j.table].alias(_alias(j.table))
        if hot.get(i) is None:
            df = df.join(other, F.expr(j.on), j.how)
        else:
            pairs = [(F.col(".".join(one)), F.col(".".join(two))) for one, two in j.equalities]
            df = dealt_join(df, other, F.expr(j.on), pairs, hot[i], j.how)
    for predicate in spec.filters:
        df = df.where(F.expr(predicate))
    return df


def _ordered_by_grain(spec: S.BuildSpec, numbered: S.ColumnMapping) -> bool:
    """Whether keys are numbered in an order that the declared grain makes unique."""
    direct = {m.target_column.lower(): m.source_columns[0].lower() for m in spec.columns if m.transformation == S.DIRECT}
    order = {c.lower() for c in numbered.order_by}
    return bool(spec.grain) and all(direct.get(c.lower()) in order for c in spec.grain)


def _generated(spec: S.BuildSpec) -> list[S.ColumnMapping]:
    return [m for m in spec.columns if m.transformation in (S.GENERATED, S.SEQUENCE)]


def stage(spec: S.BuildSpec, sources: Mapping[str, DataFrame], *,
          registry: FunctionRegistry | None = None,
          run_timestamp: datetime.datetime | None = None) -> DataFrame:
    """Source rows mapped to target columns, to be written as the staging table.

    LOOKUP columns are staged as natural keys, generated keys as positions.
    """
    mapper = Mapper(spec, registry, run_timestamp)
    columns = []
    for m in spec.columns:
        if m.transformation == S.LOOKUP:
            columns += [mapper.source(c, m.source_table).alias(lookup_column(m, i))
                        for i, (c, _) in enumerate(m.lookup.on)]
            if m.lookup.at:
                columns.append(mapper.source(m.lookup.at, m.source_table).alias(_lookup_moment(m)))
        elif m.transformation not in (S.GENERATED, S.SEQUENCE):
            columns.append(mapper.expression(m).alias(m.target_column))
    df = joined_sources(spec, sources)
    numbered = _generated(spec)
    if not numbered:
        return df.select(*columns)
    order = [mapper.source(c).alias(_order_column(i)) for i, c in enumerate(numbered[0].order_by)]
    names = [_order_column(i) for i in range(len(order))]
    return position_rows(df.select(*columns, *order), names, unique=_ordered_by_grain(spec, numbered[0])).drop(*names)


def resolve(spec: S.BuildSpec, staged: DataFrame, dimensions: Mapping[str, DataFrame], *,
            existing: DataFrame | None = None, unique: str = "trust", written: bool = False, **options) -> DataFrame:
    """Turn written staging rows into target rows, the columns in declared order.

    Dimension keys are looked up and positions become numbers; a SEQUENCE
    continues after the highest key of `existing`, the current target.  The hot
    keys of all lookups come from one sampled count.  `written` says that
    `staged` is read from files, so that equal rows can be told apart.
    """
    mapper = Mapper(spec)
    hot = _hot_lookups(spec, staged, dimensions, options.get("hot_rows", HOT_ROWS))
    if written and any(h is not None for h in hot.values()):
        # Where a row was written is its own, however many are equal to it.
        staged = staged.withColumn(PLACE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    df = staged
    numbered = _generated(spec)
    if numbered:
        df = number_positions(df, _NUMBER)
        for m in numbered:
            start = F.lit(0)
            if m.transformation == S.SEQUENCE and existing is not None:
                start = highest(existing, m.target_column)
            df = df.withColumn(m.target_column, mapper.typed(F.col(_NUMBER) + start, m))
    for m in spec.columns:
        if m.transformation != S.LOOKUP:
            continue
        at = m.lookup
        on = [(lookup_column(m, i), d) for i, (_, d) in enumerate(at.on)]
        dim, take = dimensions[at.dimension], {m.target_column: at.key}
        if at.at:
            df = lookup_as_of(df, dim, on, _lookup_moment(m), take, valid_from=at.valid_from,
                              valid_to=at.valid_to, unknown_key=at.unknown_key, sizes=staged, **options)
        else:
            df = lookup(df, dim, on, take, unknown_key=at.unknown_key, unique=unique, sizes=staged,
                        hot=hot.get(m.target_column, LOOK), **options)
        df = df.withColumn(m.target_column, mapper.typed(F.col(m.target_column), m))
    return df.select(*[c.name for c in spec.target.columns])


def _hot_lookups(spec: S.BuildSpec, staged: DataFrame, dimensions: Mapping[str, DataFrame],
                 hot_rows: int | None) -> dict[str, DataFrame | None]:
    """Hot keys per LOOKUP column whose dimension is not broadcast."""
    if hot_rows is None:
        return {}
    wanted = {m.target_column: [lookup_column(m, i) for i in range(len(m.lookup.on))] for m in spec.columns
              if m.transformation == S.LOOKUP and not m.lookup.at and not planned_small(dimensions[m.lookup.dimension])}
    return dict(zip(wanted, hot_keys_of_all(staged, list(wanted.values()), hot_rows)))


def build(spec: S.BuildSpec, sources: Mapping[str, DataFrame],
          dimensions: Mapping[str, DataFrame] | None = None, *, existing: DataFrame | None = None,
          registry: FunctionRegistry | None = None, run_timestamp: datetime.datetime | None = None,
          unique: str = "verify", **lookups) -> DataFrame:
    """stage and resolve in one go; rows with generated keys are written to the shared folder.

    A dimension that repeats a lookup key fails the job unless `unique` is
    'trust'; further options go to the lookups.
    """
    staged = stage(spec, sources, registry=registry, run_timestamp=run_timestamp)
    if _generated(spec):
        staged = materialise(staged, spec.staging_table)
    return resolve(spec, staged, dimensions or {}, existing=existing, unique=unique,
                   written=bool(_generated(spec)), **lookups)
