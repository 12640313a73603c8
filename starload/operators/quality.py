"""Checks of loaded data, each a DataFrame of (check_id, category, status, detail, n).

`n` is the number of offending rows, groups or columns.  Checks run as Spark
aggregations and joins and can be united into one report.  They are lazy, but for
the recomputation, which may look for hot keys first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starload import spec as S
from starload.local import small_frame
from starload.operators.skew import HOT_ROWS, attach

# Statuses and categories.  Statuses are listed from good to bad.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
STATUSES = (PASS, WARN, FAIL)
SCHEMA, DATA = "schema", "data"

# Check ids.
ID_TABLE = "S-{label}-{table}"
ID_COLUMN = "S-{label}-{table}.{column}"
ID_ROWCOUNT = "D-rowcount-{table}"
ID_DUPLICATES = "D-duplicates-{table}"
ID_GRAIN = "D-grain-{table}"
ID_NOTNULL = "D-notnull-{table}.{column}"
ID_FK = "D-fk-{table}.{column}"
ID_UDF = "D-udf-{table}"
ID_UDF_COLUMN = "D-udf-{table}.{column}"
ID_WIDTH = "D-width-{table}.{column}"
ID_PARSE = "D-parse-{table}.{column}"
ID_DRIFT = "D-drift-{table}"
ID_LATE = "D-late-{table}"
ID_REJECTED = "D-rejected-{table}"

# Texts.  {n} stands for the count that the check computes.
TEXT_NO_TABLE = "table '{table}' not found in live {label} database"
TEXT_NO_COLUMN = "column '{column}' missing from live table '{table}'"
TEXT_TYPE = "type mismatch: declared '{declared}', live '{live}'"
TEXT_VARCHAR = "varchar({n})"
TEXT_SCHEMA_OK = "matches live schema"
TEXT_COUNTS = "staging={staging}, target={target}"
TEXT_COUNTS_FILTERED = "{counts} (buildspec declares filter(s), exact match not asserted)"
TEXT_DUPLICATES = "{n} duplicate primary-key group(s) on ({columns})"
TEXT_UNIQUE = "({columns}) unique"
TEXT_GRAIN = "{n} group(s) with more than one row on ({columns})"
TEXT_NULLS = "{n} unexpected NULL(s) in NOT NULL column"
TEXT_NO_NULLS = "no NULLs"
TEXT_ORPHANS = "{n} row(s) with {column} not found in {ref}"
TEXT_RESOLVED = "all {column} values resolve to {ref}"
TEXT_MISMATCH = "{n}/{checked} row(s) mismatch re-invoking {function}(...)"
TEXT_UNCHECKED = "no rows to check"
TEXT_NO_KEY = "no reliable join key from the source primary key; skipping recomputation"
TEXT_SKIPPED = "{detail}; {skipped} row(s) without one source row of their key not compared"
TEXT_WIDE = "{n} value(s) longer than {width}, longest {longest}"
TEXT_WIDTH_OK = "longest value {longest} of {width}"
TEXT_UNPARSED = "{n} value(s) could not be parsed"
TEXT_PARSED = "all values parsed"
TEXT_DRIFT = "{missing} missing, {added} added, {changed} hash mismatch"
TEXT_NO_DRIFT = "no drift"
TEXT_LATE = "{n} row(s) older than the current version, not applied"
TEXT_LATE_APPEND = "{n} row(s) older than the newest loaded row, not appended"
TEXT_NO_INCREMENT_KEY = "no reliable key: rows at or before the newest loaded moment cannot be told from loaded ones"
TEXT_NO_BATCH_KEY = "no reliable key: the rows of the batch cannot be found in the target"
TEXT_NOT_LATE = "no late rows"
TEXT_REJECTED = "{n} record(s) could not be read"
TEXT_NOT_REJECTED = "all records read"

REPORT = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("n", T.LongType()),
])


def text(template: str, **values: object) -> Column:
    """A fixed text with Columns and constants put in for its {names}."""
    out, rest = [], template
    while "{" in rest:
        literal, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        value = values[name]
        out += [F.lit(literal), value.cast("string") if isinstance(value, Column) else F.lit(str(value))]
    return F.concat(*out, F.lit(rest))


def verdict(bad: Column, otherwise: str = FAIL) -> Column:
    return F.when(bad, otherwise).otherwise(PASS)


def _rows(df: DataFrame, check_id: str, status: Column, detail: Column, n: Column,
          category: str = DATA) -> DataFrame:
    return df.select(F.lit(check_id).alias("check_id"), F.lit(category).alias("category"),
                     status.alias("status"), detail.alias("detail"), n.cast("bigint").alias("n"))


def constant_check(spark: SparkSession, check_id: str, status: str, detail: str, category: str) -> DataFrame:
    return small_frame(spark, [(check_id, category, status, detail, int(status != PASS))], REPORT)


def unpivot(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One report row per entry of a one-row aggregate."""
    return df.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def entry(check_id: str, status: Column, detail: Column, n: Column, category: str = DATA) -> Column:
    return F.struct(F.lit(check_id).alias("check_id"), F.lit(category).alias("category"),
                    status.alias("status"), detail.alias("detail"), n.cast("bigint").alias("n"))


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


# --- schema -------------------------------------------------------------------------


def type_matches(declared: S.ColumnSpec, live: T.StructField) -> bool:
    """Loose comparison: aliases, VARCHAR length where the live column knows it, no precision."""
    wanted = declared.checked_type
    if wanted is None:
        return True
    if live.dataType.typeName().partition("(")[0] != T.DataType.fromDDL(wanted).typeName():
        return False
    known = live.metadata.get("__CHAR_VARCHAR_TYPE_STRING")
    return declared.width is None or known is None or known == f"varchar({declared.width})"


def check_schema(spec: S.TableSpec, live: DataFrame | None, spark: SparkSession,
                 label: str = "target") -> DataFrame:
    """Declared against live columns.  Nullability is checked on data, extra columns are fine.

    Files read by path do not know VARCHAR lengths, so there the longest value
    is measured instead, for all such columns in one scan.
    """
    names = {"label": label, "table": spec.name}
    if live is None:
        return constant_check(spark, ID_TABLE.format(**names), FAIL, TEXT_NO_TABLE.format(**names), SCHEMA)
    fields = {f.name.lower(): f for f in live.schema}
    measured = [c for c in spec.columns if c.width and (f := fields.get(c.name.lower()))
                and type_matches(c, f) and "__CHAR_VARCHAR_TYPE_STRING" not in f.metadata]
    checks = []
    for c in spec.columns:
        check_id = ID_COLUMN.format(column=c.name, **names)
        field = fields.get(c.name.lower())
        problem = None
        if field is None:
            problem = TEXT_NO_COLUMN.format(column=c.name, **names)
        elif not type_matches(c, field):
            problem = TEXT_TYPE.format(declared=c.type, live=field.dataType.simpleString())
        if c not in measured:
            checks.append((check_id, SCHEMA, FAIL if problem else PASS, problem or TEXT_SCHEMA_OK, int(bool(problem))))
    known = small_frame(spark, checks, REPORT)
    if not measured:
        return known
    lengths = live.agg(*[F.max(F.length(c.name)).alias(c.name) for c in measured])
    entries = []
    for c in measured:
        wide = F.coalesce(F.col(c.name) > c.width, F.lit(False))
        found = text(TEXT_TYPE, declared=c.type, live=text(TEXT_VARCHAR, n=F.col(c.name)))
        entries.append(entry(ID_COLUMN.format(column=c.name, **names), verdict(wide),
                              F.when(wide, found).otherwise(TEXT_SCHEMA_OK), wide.cast("int"), SCHEMA))
    return known.unionByName(unpivot(lengths, entries))


# --- counts, NULLs, widths ----------------------------------------------------------


def check_row_count(table: str, staging: DataFrame, target: DataFrame, filtered: bool = False) -> DataFrame:
    """Staged against loaded rows; with declared filters the counts are only reported."""
    sides = [df.agg(F.count(F.lit(1)).alias(mine)).withColumn(other, F.lit(0))
             for df, mine, other in ((staging, "staging", "target"), (target, "target", "staging"))]
    both = sides[0].unionByName(sides[1]).agg(F.sum("staging").alias("staging"), F.sum("target").alias("target"))
    counts = text(TEXT_COUNTS, staging=F.col("staging"), target=F.col("target"))
    status, detail = verdict(F.col("staging") != F.col("target")), counts
    if filtered:
        status, detail = F.lit(WARN), text(TEXT_COUNTS_FILTERED, counts=counts)
    return _rows(both, ID_ROWCOUNT.format(table=table), status, detail,
                 F.abs(F.col("staging") - F.col("target")))


def check_not_null(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs in every NOT NULL column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(counts, [
        entry(ID_NOTNULL.format(table=table, column=c), verdict(F.col(c) > 0),
               F.when(F.col(c) > 0, text(TEXT_NULLS, n=F.col(c))).otherwise(TEXT_NO_NULLS), F.col(c))
        for c in columns])


def check_width(table: str, df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Values longer than their declared VARCHAR(n), all columns in one scan; a warning."""
    measured = df.agg(*[F.struct(F.count_if(F.length(c) > w).alias("wide"),
                                 F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest")).alias(c)
                        for c, w in widths.items()])
    entries = []
    for c, w in widths.items():
        wide, longest = F.col(f"{c}.wide"), F.col(f"{c}.longest")
        detail = (F.when(wide > 0, text(TEXT_WIDE, n=wide, width=w, longest=longest))
                  .otherwise(text(TEXT_WIDTH_OK, width=w, longest=longest)))
        entries.append(entry(ID_WIDTH.format(table=table, column=c), verdict(wide > 0, WARN), detail, wide))
    return unpivot(measured, entries)


def check_parsed(table: str, df: DataFrame, parsed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Raw values that are not NULL although their parsed value is; a warning.

    `parsed` is column name -> (raw, parsed) over df.
    """
    lost = df.agg(*[F.count_if(raw.isNotNull() & value.isNull()).alias(c)
                    for c, (raw, value) in parsed.items()])
    return unpivot(lost, [
        entry(ID_PARSE.format(table=table, column=c), verdict(F.col(c) > 0, WARN),
               F.when(F.col(c) > 0, text(TEXT_UNPARSED, n=F.col(c))).otherwise(TEXT_PARSED), F.col(c))
        for c in parsed])


# --- keys ---------------------------------------------------------------------------


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once and how often; NULL is a value here."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_unique(table: str, df: DataFrame, keys: Sequence[str], *, grain: bool = False) -> DataFrame:
    """Number of duplicate key groups; an empty table gives no row."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    found = groups.agg(F.count_if(F.col("rows") > 1).alias("n"), F.sum("rows").alias("rows"))
    columns = ", ".join(keys)
    detail = (F.when(F.col("n") > 0, text(TEXT_GRAIN if grain else TEXT_DUPLICATES, n=F.col("n"), columns=columns))
              .otherwise(text(TEXT_UNIQUE, columns=columns)))
    check_id = (ID_GRAIN if grain else ID_DUPLICATES).format(table=table)
    return _rows(found.where("rows > 0"), check_id, verdict(F.col("n") > 0), detail, F.col("n"))


def check_foreign_key(table: str, df: DataFrame, column: str, ref: DataFrame, ref_table: str,
                      ref_column: str, *, enforced: bool = True) -> DataFrame:
    """Rows whose non-NULL key has no row in `ref`; only a warning if the key is not enforced.

    Rows are counted per key value before the join, so a value that a third of
    the rows share is one row in it.
    """
    used = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("rows")))
    known = ref.select(F.col(ref_column).alias("known"))
    lost = (used.join(known, F.col("value") == F.col("known"), "left_anti")
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")))
    names = {"column": column, "ref": f"{ref_table}.{ref_column}"}
    detail = (F.when(F.col("n") > 0, text(TEXT_ORPHANS, n=F.col("n"), **names))
              .otherwise(text(TEXT_RESOLVED, **names)))
    return _rows(lost, ID_FK.format(table=table, column=column),
                 verdict(F.col("n") > 0, FAIL if enforced else WARN), detail, F.col("n"))


# --- recomputation ------------------------------------------------------------------


def recompute(target: DataFrame, source: DataFrame, keys: Mapping[str, Column],
              expected: Mapping[str, Column], *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row: rows checked and skipped, and per column how many differ from the value computed again.

    `keys` and `expected` are target column -> Column over `source`.  A loaded NULL
    equals a computed NULL.  Target rows without a source row are skipped, as are
    those whose key is NULL or not unique in the source, because it is unknown
    which row they came from; `skipped` is their number.  Unless `hot_rows` is
    None, finding hot keys runs a job at once.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    again = source.select(*[e.alias(n) for n, e in zip(names, keys.values())],
                          F.struct(*[e.alias(c) for c, e in expected.items()]).alias("_again"))
    again = (again.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.max("_again").alias("_again"))
             .where("_n = 1").drop("_n"))
    loaded = target.select(*[F.col(c).alias(n) for n, c in zip(names, keys)],
                           F.struct(*expected).alias("_loaded"))
    pairs = attach(loaded, again, names, "left", hot_rows=hot_rows)
    found = F.col("_again").isNotNull()
    return pairs.agg(
        F.count_if(found).alias("checked"), F.count_if(~found).alias("skipped"),
        *[F.count_if(found & ~F.col("_loaded")[c].eqNullSafe(F.col("_again")[c])).alias(c) for c in expected])


# --- drift --------------------------------------------------------------------------

# Kinds of drift.
MISSING_ROW, ADDED_ROW, HASH_MISMATCH = "missing", "added", "hash mismatch"


def drift(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys that differ between two snapshots and how: missing, added or hash mismatch.

    Rows are reduced to signed sums of their hashes per key, so keys may repeat
    and no pairs of rows are formed.
    """
    # Two 64-bit hashes make one of 128 bits; the NULL flags tell NULL from no column.
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]

    def side(df: DataFrame, sign: int) -> DataFrame:
        hashes = [(F.lit(sign) * h.cast("decimal(20,0)")).alias(n)
                  for n, h in (("_hash1", F.xxhash64(*parts)), ("_hash2", F.xxhash64(F.lit(1), *parts)))]
        return df.select(*keys, *hashes, F.lit(sign).alias("_sign"))

    # The sums are those of a multiset of rows, whatever their order, and are combined before the one shuffle.
    per_key = side(before, -1).unionByName(side(after, 1)).groupBy(*keys).agg(
        F.sum("_hash1").alias("_sum1"), F.sum("_hash2").alias("_sum2"),
        F.count_if(F.col("_sign") < 0).alias("_before"), F.count_if(F.col("_sign") > 0).alias("_after"))
    differs = (F.col("_before") != F.col("_after")) | (F.col("_sum1") != 0) | (F.col("_sum2") != 0)
    kind = (F.when(F.col("_after") == 0, MISSING_ROW).when(F.col("_before") == 0, ADDED_ROW)
            .otherwise(HASH_MISMATCH))
    return per_key.where(differs).select(*keys, kind.alias("drift"))


def check_drift(table: str, before: DataFrame, after: DataFrame, keys: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """A warning when two snapshots differ."""
    kinds = {"missing": MISSING_ROW, "added": ADDED_ROW, "changed": HASH_MISMATCH}
    counts = drift(before, after, keys, columns).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("drift") == k).alias(a) for a, k in kinds.items()])
    found = F.col("n") > 0
    detail = F.when(found, text(TEXT_DRIFT, **{a: F.col(a) for a in kinds})).otherwise(TEXT_NO_DRIFT)
    return _rows(counts, ID_DRIFT.format(table=table), verdict(found, WARN), detail, F.col("n"))


def check_late(table: str, late: DataFrame, found: str = TEXT_LATE) -> DataFrame:
    """A warning when a load leaves out rows that came too late.

    `late` is a one-row frame with their number `n`.
    """
    n = F.col("n")
    detail = F.when(n > 0, text(found, n=n)).otherwise(TEXT_NOT_LATE)
    return _rows(late, ID_LATE.format(table=table), verdict(n > 0, WARN), detail, n)


def check_rejected(table: str, rejected: DataFrame) -> DataFrame:
    """A warning when records of a source could not be read; `rejected` holds them."""
    n = F.col("n")
    detail = F.when(n > 0, text(TEXT_REJECTED, n=n)).otherwise(TEXT_NOT_REJECTED)
    return _rows(rejected.agg(F.count(F.lit(1)).alias("n")), ID_REJECTED.format(table=table), verdict(n > 0, WARN), detail, n)


# --- whole tables and reports -------------------------------------------------------


def check_table(spec: S.TableSpec, df: DataFrame, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Primary key, NOT NULL and foreign keys of one loaded table."""
    checks = []
    if spec.primary_key:
        checks.append(check_unique(spec.name, df, spec.primary_key))
    if spec.not_null:
        checks.append(check_not_null(spec.name, df, spec.not_null))
    for c in spec.foreign_keys:
        fk = c.foreign_key
        if references and fk.table in references:
            checks.append(check_foreign_key(spec.name, df, c.name, references[fk.table],
                                            fk.table, fk.column, enforced=fk.enforced))
    return union_checks(checks) if checks else small_frame(df.sparkSession, [], REPORT)


def status_rank(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATUSES]), status)


def worst_status(status: Column) -> Column:
    """Aggregate: FAIL if any, else WARN if any, else PASS."""
    rank = F.coalesce(F.max(status_rank(status)), F.lit(1)).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in STATUSES]), rank)


def table_of_check(check_id: Column) -> Column:
    """The table a check id is about."""
    return F.regexp_extract(check_id, r"^D-[a-z]+-([^.]+)", 1)


def roll_up(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Worst status and counts per status, overall or per group."""
    return report.groupBy(*by).agg(
        worst_status(F.col("status")).alias("status"), F.count(F.lit(1)).alias("checks"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES])


def summarise(report: DataFrame) -> DataFrame:
    """Number of checks per category and status."""
    return report.groupBy("category", "status").agg(F.count(F.lit(1)).alias("checks"))


def exit_code(report: DataFrame) -> int:
    """1 if any check failed, else 0; a warning does not fail a run."""
    return int(roll_up(report).first()["status"] == FAIL)
