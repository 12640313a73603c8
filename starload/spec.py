"""Declarations: what a table looks like and where each of its columns comes from.

A `TableSpec` describes one table, a `BuildSpec` says how one target table is
filled.  Both are checked when they are constructed, before any Spark job.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

# Declared type spelling -> Spark type name.  A spelling that is
# not listed is accepted without a type check.
TYPE_ALIASES = {
    "INT": "int",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "SMALLINT": "smallint",
    "VARCHAR": "string",
    "CHARACTER VARYING": "string",
    "TEXT": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
    "NUMERIC": "decimal",
    "DECIMAL": "decimal",
}

# Further spellings, stored with this Spark type but not type-checked.
STORED_TYPES = {
    "BIGSERIAL": "bigint",
    "BINARY": "binary",
    "BLOB": "binary",
    "BOOL": "boolean",
    "BYTEA": "binary",
    "CHAR": "string",
    "CHARACTER": "string",
    "CLOB": "string",
    "DATETIME": "timestamp_ntz",
    "DOUBLE": "double",
    "DOUBLE PRECISION": "double",
    "FLOAT": "double",
    "FLOAT4": "float",
    "FLOAT8": "double",
    "INT2": "smallint",
    "INT4": "int",
    "INT8": "bigint",
    "JSON": "string",
    "JSONB": "string",
    "LONG": "bigint",
    "NVARCHAR": "string",
    "REAL": "float",
    "SERIAL": "int",
    "SMALLSERIAL": "smallint",
    "STRING": "string",
    "TIME": "string",
    "TIME WITH TIME ZONE": "string",
    "TIME WITHOUT TIME ZONE": "string",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
    "TIMESTAMP WITHOUT TIME ZONE": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp",
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "TINYINT": "tinyint",
    "UUID": "string",
    "VARBINARY": "binary",
}

# The ten mapping kinds and the load strategies.
DIRECT = "DIRECT"
EXPRESSION = "EXPRESSION"
UDF = "UDF"
CONSTANT = "CONSTANT"
LOOKUP = "LOOKUP"
GENERATED = "GENERATED"
DEFAULT = "DEFAULT"
SEQUENCE = "SEQUENCE"
UUID = "UUID"
NEEDS_REVIEW = "NEEDS_REVIEW"
KINDS = (DIRECT, EXPRESSION, UDF, CONSTANT, LOOKUP, GENERATED, DEFAULT, SEQUENCE, UUID, NEEDS_REVIEW)
LOAD_STRATEGIES = ("full_load", "incremental", "scd2")

# The columns that a versioned table has besides its own.
HASHDIFF, VALID_FROM, VALID_TO, IS_CURRENT = "hashdiff", "valid_from", "valid_to", "is_current"
VERSION_COLUMNS = (HASHDIFF, VALID_FROM, VALID_TO, IS_CURRENT)


class SpecError(ValueError):
    """A declaration that cannot be built; raised before any Spark job starts."""


def _split_type(declared: str) -> tuple[str, tuple[int, ...]]:
    """Base and numbers of a spelling: TIMESTAMP(6) WITH TIME ZONE is (TIMESTAMP WITH TIME ZONE, (6,))."""
    match = re.fullmatch(r"([^()]*)(?:\(\s*(\d+(?:\s*,\s*\d+)*)\s*\))?([^()]*)", declared.strip().upper())
    if match is None:
        raise SpecError(f"cannot read the declared type {declared!r}")
    base = " ".join(f"{match[1]} {match[3]}".split())
    return base, tuple(int(n) for n in match[2].split(",")) if match[2] else ()


def comment(description: str) -> str:
    """A COMMENT clause, empty without a description."""
    quoted = description.replace("\\", "\\\\").replace("'", "\\'")
    return f" COMMENT '{quoted}'" if description else ""


@dataclass(frozen=True)
class ForeignKey:
    """`enforced=False` marks lineage only, e.g. to a business key that repeats per version."""

    table: str
    column: str
    enforced: bool = True


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    primary_key: bool = False
    foreign_key: ForeignKey | None = None
    description: str = ""

    @property
    def width(self) -> int | None:
        """n of VARCHAR(n), else None."""
        base, numbers = _split_type(self.type)
        return numbers[0] if base in ("VARCHAR", "CHARACTER VARYING") and numbers else None

    @property
    def checked_type(self) -> str | None:
        """Spark type name to compare with, or None for a spelling that is not checked."""
        return TYPE_ALIASES.get(_split_type(self.type)[0])

    @property
    def spark_type(self) -> T.DataType:
        """Type the column is stored as; a spelling without one cannot be built."""
        base, numbers = _split_type(self.type)
        name = TYPE_ALIASES.get(base)
        if name == "decimal":
            # Without a precision the type has as many places as leave room for amounts: 20 digits before, 18 after.
            return T.DecimalType(*(numbers or (38, 18)))
        stored = name or STORED_TYPES.get(base)
        if stored is None:
            raise SpecError(f"{self.name}: no Spark type for the declared type {self.type!r}")
        return T.DataType.fromDDL(stored)

    @property
    def ddl(self) -> str:
        """Column definition for CREATE TABLE; VARCHAR(n) keeps its length."""
        stored = f"VARCHAR({self.width})" if self.width else self.spark_type.simpleString()
        return f"`{self.name}` {stored}{comment(self.description)}"


@dataclass(frozen=True)
class TableSpec:
    namespace: str
    name: str
    columns: tuple[ColumnSpec, ...]
    partition_by: tuple[str, ...] = ()
    description: str = ""
    # Bucketed by its join key, a table is joined and checked on it without a shuffle.
    # For keys without hot values only, as all rows of a value share one file.
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self) -> None:
        seen = [c.name.lower() for c in self.columns]
        twice = sorted({n for n in seen if seen.count(n) > 1})
        if twice:
            raise SpecError(f"{self.full_name}: column(s) declared twice: {twice}")
        missing = sorted({*self.partition_by, *self.bucket_by} - {c.name for c in self.columns})
        if missing:
            raise SpecError(f"{self.full_name}: unknown partition or bucket column(s): {missing}")
        if bool(self.bucket_by) != (self.buckets > 0):
            raise SpecError(f"{self.full_name}: bucket columns and a number of buckets go together")

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def foreign_keys(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.foreign_key is not None]

    def column(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)

    @property
    def struct(self) -> T.StructType:
        """Schema for a typed read; the declaration rides along as field metadata."""
        fields = []
        for c in self.columns:
            meta: dict[str, Any] = {"sql_type": c.type, "pk": c.primary_key}
            if c.foreign_key:
                meta["fk"] = {"table": c.foreign_key.table, "column": c.foreign_key.column}
            fields.append(T.StructField(c.name, c.spark_type, True, meta))
        return T.StructType(fields)


def column(name: str, type: str, *, pk: bool = False, nullable: bool | None = None,
           fk: tuple[str, str] | ForeignKey | None = None, description: str = "") -> ColumnSpec:
    """Short form of ColumnSpec; a primary key column is NOT NULL unless said otherwise."""
    if isinstance(fk, tuple):
        fk = ForeignKey(*fk)
    return ColumnSpec(name, type, (not pk) if nullable is None else nullable, pk, fk, description)


@dataclass(frozen=True)
class Lookup:
    """Where a LOOKUP column finds its key.

    `on` pairs source columns with dimension columns.  With `at` set, the
    dimension is versioned and the version valid at that source column is used.
    """

    dimension: str
    key: str
    on: tuple[tuple[str, str], ...]
    unknown_key: Any = None
    at: str | None = None
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"


@dataclass(frozen=True)
class Call:
    """A function applied to source columns, to RUN_TIMESTAMP or to further calls."""

    function: str
    arguments: tuple[str | Call, ...]

    @property
    def source_columns(self) -> tuple[str, ...]:
        """Lineage: every source column any level of the call reads."""
        names: list[str] = []
        for a in self.arguments:
            names += a.source_columns if isinstance(a, Call) else [a] if a != RUN_TIMESTAMP else []
        return tuple(dict.fromkeys(names))


# The one timestamp of a run, as an argument of a call or as the source of a column.
RUN_TIMESTAMP = "@run_timestamp"


def calls_any(function: str | Call | None, names: Sequence[str]) -> bool:
    """Whether a function or one inside a call is one of `names`, in any letter case."""
    if isinstance(function, Call):
        return calls_any(function.function, names) or any(
            isinstance(a, Call) and calls_any(a, names) for a in function.arguments)
    return function is not None and function.lower() in names


def reads_run_timestamp(function: str | Call | None) -> bool:
    """Whether a call reads the moment of the run at any level."""
    return isinstance(function, Call) and any(
        reads_run_timestamp(a) if isinstance(a, Call) else a == RUN_TIMESTAMP for a in function.arguments)


@dataclass(frozen=True)
class ColumnMapping:
    target_column: str
    transformation: str
    source_column: str | tuple[str, ...] | None = None
    source_table: str | None = None
    expression: str | None = None
    udf: str | Call | None = None
    value: Any = None
    lookup: Lookup | None = None
    order_by: tuple[str, ...] = ()
    type: str | None = None
    try_cast: bool = False
    notes: str = ""

    @property
    def source_columns(self) -> tuple[str, ...]:
        if isinstance(self.udf, Call):
            return self.udf.source_columns
        if self.source_column is None:
            return ()
        return (self.source_column,) if isinstance(self.source_column, str) else tuple(self.source_column)

    def problem(self) -> str | None:
        """Why this mapping cannot be built, or None."""
        if self.transformation not in KINDS:
            return f"unknown transformation {self.transformation!r}"
        if self.transformation == NEEDS_REVIEW:
            return "NEEDS_REVIEW: the mapping is unresolved and is never guessed"
        needs = {
            DIRECT: ("source_column", len(self.source_columns) == 1),
            EXPRESSION: ("expression", bool(self.expression)),
            UDF: ("udf", bool(self.udf)),
            LOOKUP: ("lookup", self.lookup is not None),
            GENERATED: ("order_by", bool(self.order_by)),
            SEQUENCE: ("order_by", bool(self.order_by)),
            UUID: ("source_column", bool(self.source_columns)),
        }
        what, present = needs.get(self.transformation, ("", True))
        return None if present else f"{self.transformation} needs {what}"


_COLUMN = r"`?(\w+)`?\.`?(\w+)`?"


@dataclass(frozen=True)
class Join:
    """One more source table; `on` is a Spark SQL predicate over qualified columns.

    It has at least one equality of two columns among the conditions that AND
    joins: without one, every row would be held against every other.
    """

    table: str
    on: str
    how: str = "left"

    def __post_init__(self) -> None:
        if not self.equalities:
            raise SpecError(f"join of {self.table}: no equality of a column of each table in {self.on!r}")

    @property
    def equalities(self) -> list[tuple[tuple[str, str], tuple[str, str]]]:
        """((table, column), (table, column)) of every equality, the joined table on the right."""
        mine, found = self.table.rpartition(".")[2].lower(), []
        for condition in re.split(r"\band\b", self.on, flags=re.IGNORECASE):
            match = re.fullmatch(rf"[\s(]*{_COLUMN}\s*(?:<=>|==?)\s*{_COLUMN}[\s)]*", condition)
            if match:
                one, other = (match[1], match[2]), (match[3], match[4])
                if other[0].lower() != mine:
                    one, other = other, one
                if other[0].lower() == mine and one[0].lower() != mine:
                    found.append((one, other))
        return found


@dataclass(frozen=True)
class BuildSpec:
    target: TableSpec
    source_tables: tuple[str, ...]
    columns: tuple[ColumnMapping, ...]
    load_strategy: str = "full_load"
    staging_table: str = ""
    joins: tuple[Join, ...] = ()
    filters: tuple[str, ...] = ()
    grain: tuple[str, ...] = ()
    load_options: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        name = self.target.name
        if not self.staging_table:
            object.__setattr__(self, "staging_table", f"stg_{name.lower()}")
        if self.load_strategy not in LOAD_STRATEGIES:
            raise SpecError(f"{name}: unknown load strategy {self.load_strategy!r}")
        if not self.source_tables:
            raise SpecError(f"{name}: no source table")
        problems = [f"{c.target_column}: {p}" for c in self.columns if (p := c.problem())]
        if problems:
            raise SpecError(f"{name}: " + "; ".join(problems))
        mapped = [c.target_column.lower() for c in self.columns]
        declared = [c.name.lower() for c in self.target.columns]
        if sorted(mapped) != sorted(declared):
            lost = sorted(set(declared) - set(mapped))
            extra = sorted(set(mapped) - set(declared))
            raise SpecError(f"{name}: columns without mapping {lost}, mappings without column {extra}")
        unknown = sorted({j.table for j in self.joins} - set(self.source_tables))
        if unknown:
            raise SpecError(f"{name}: joined table(s) that are not source tables: {unknown}")
        numbered = [c for c in self.columns if c.transformation in (GENERATED, SEQUENCE)]
        if len({c.order_by for c in numbered}) > 1:
            raise SpecError(f"{name}: generated keys must share one order")
        self._check_strategy()

    def _check_strategy(self) -> None:
        """A strategy is never downgraded: what it needs must be there."""
        name, options = self.target.name, self.load_options
        if self.load_strategy == "full_load":
            return
        if any(c.transformation == GENERATED for c in self.columns):
            raise SpecError(f"{name}: GENERATED starts at 1 in every load; use SEQUENCE for {self.load_strategy}")
        if self.load_strategy == "incremental":
            if "timestamp" not in options or not ({"keys", "source_timestamp"} & set(options)):
                raise SpecError(f"{name}: incremental needs timestamp and either source_timestamp"
                                " (append newer rows) or keys (upsert)")
            return
        lost = [o for o in ("keys", "tracked") if not options.get(o)]
        lost += [c for c in VERSION_COLUMNS if self.target.column(c) is None]
        if lost:
            raise SpecError(f"{name}: scd2 needs {', '.join(lost)}")

    @property
    def base_table(self) -> str:
        return self.source_tables[0]

    def mapping(self, target_column: str) -> ColumnMapping:
        return next(c for c in self.columns if c.target_column.lower() == target_column.lower())


# --- documents -> specs -------------------------------------------------------------


def tables_from_document(doc: Mapping[str, Any], namespace: str | None = None) -> dict[str, TableSpec]:
    """Table specs from a schema document: {schema, tables: [{name, columns: [...]}]}."""
    space = namespace or doc.get("schema") or doc["database"]
    specs = {}
    for t in doc["tables"]:
        columns = []
        for c in t["columns"]:
            fk = c.get("foreign_key")
            columns.append(ColumnSpec(
                c["name"], c["type"], c.get("nullable", True), c.get("primary_key", False),
                ForeignKey(fk["table"], fk["column"], fk.get("enforced", True)) if fk else None,
                c.get("description", ""),
            ))
        specs[t["name"]] = TableSpec(space, t["name"], tuple(columns), description=t.get("description", ""))
    return specs


def build_from_document(doc: Mapping[str, Any], target: TableSpec,
                        sources: Mapping[str, TableSpec] | None = None) -> BuildSpec:
    """Build spec from a build document: {source_tables, columns, joins, filters, grain, ...}.

    A free-text `grain` is kept out of the spec, a list of columns is checked;
    `lookup`, `joins` and `value` use the field names of the classes above.
    What a document leaves open is taken from `sources`, see `complete`.
    """
    columns = []
    for c in doc["columns"]:
        source = c.get("source") or {}
        names = source.get("column")
        generator = c.get("generator") or {}
        columns.append(ColumnMapping(
            c["target_column"], c["transformation"],
            tuple(names) if isinstance(names, list) else names,
            source.get("table"), c.get("expression"), c.get("udf"), c.get("value"), _lookup(c.get("lookup")),
            _names(generator.get("order_by")), c.get("type"), c.get("try_cast", False), c.get("notes") or "",
        ))
    grain = doc.get("grain")
    tables = tuple(s["table"] for s in doc["source_tables"])
    return BuildSpec(
        target, tables, complete(columns, target, tables[0], sources or {}),
        doc.get("load_strategy", "full_load"),
        doc.get("staging_table", ""),
        tuple(Join(**j) for j in doc.get("joins", [])),
        tuple(doc.get("filters", [])),
        tuple(grain) if isinstance(grain, list) else (),
        doc.get("load_options", {}),
    )


def builds_from_mappings(rows: Sequence[Mapping[str, Any]], targets: Mapping[str, TableSpec],
                         sources: Mapping[str, TableSpec] | None = None, **options: Any) -> list[BuildSpec]:
    """Build specs from mapping rows, one per target table, in the order of the rows.

    A row has target_table, target_column, source_table, source_column (several
    separated by commas), transformation, transformation_detail and
    udf_reference.  The detail is the text of an EXPRESSION and the value of a
    CONSTANT or DEFAULT.  `options` are further fields of every build spec.
    """
    grouped: dict[str, list[Mapping[str, Any]]] = {}
    for row in rows:
        grouped.setdefault(row["target_table"], []).append(row)
    specs = []
    for table, own in grouped.items():
        tables = tuple(dict.fromkeys(r["source_table"] for r in own if r.get("source_table")))
        if not tables:
            raise SpecError(f"{table}: no mapping row names a source table")
        columns = []
        for r in own:
            kind, detail = r["transformation"], r.get("transformation_detail")
            names = tuple(n.strip() for n in (r.get("source_column") or "").split(",") if n.strip())
            columns.append(ColumnMapping(
                r["target_column"], kind, names or None, r.get("source_table"),
                detail if kind == EXPRESSION else None, r.get("udf_reference"),
                detail if kind in (CONSTANT, DEFAULT) else None, _lookup(r.get("lookup")),
                _names(r.get("order_by")), notes=r.get("notes") or ""))
        specs.append(BuildSpec(targets[table], tables, complete(columns, targets[table], tables[0], sources or {}),
                               **options))
    return specs


def complete(columns: Sequence[ColumnMapping], target: TableSpec, base_table: str,
             sources: Mapping[str, TableSpec]) -> tuple[ColumnMapping, ...]:
    """Fill in what follows from the declared tables (chosen here).

    Generated keys without an order follow the primary key of the base table.  A
    LOOKUP without details goes to the table that its foreign key names, and
    matches on the dimension column named like the source column.
    """
    base = sources.get(base_table)
    done = []
    for m in columns:
        fk = c.foreign_key if (c := target.column(m.target_column)) else None
        if m.transformation in (GENERATED, SEQUENCE) and not m.order_by and base is not None:
            m = replace(m, order_by=tuple(base.primary_key))
        elif m.transformation == LOOKUP and m.lookup is None and fk is not None and m.source_columns:
            m = replace(m, lookup=Lookup(fk.table, fk.column, tuple((n, n) for n in m.source_columns)))
        done.append(m)
    return tuple(done)


def _lookup(doc: Mapping[str, Any] | None) -> Lookup | None:
    return Lookup(**{**doc, "on": tuple(tuple(p) for p in doc["on"])}) if doc else None


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)
