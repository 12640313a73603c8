"""Text files into source tables: records that do not fit are kept beside them and counted, never lost or made NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starload.operators import quality
from starload.scratch import workspace, materialise
from starload.sources import readers
from starload.sources.warehouse import STAGING, Warehouse
from starload.spec import TableSpec


def rejected_table(table: str) -> str:
    """Staging table of the records that were not taken into a source table."""
    return f"rejected_{table.lower()}"


def ingest(warehouse: Warehouse, spec: TableSpec, path: str | list[str], format: str, *, add: bool = False,
           **options: str) -> DataFrame:
    """Read csv or json files into a source table; returns the check of what was rejected.

    Records that do not fit the declared columns go to `staging.rejected_<table>`
    with their file and whole text, until the next ingest.  `add` keeps the rows
    that the table has.
    """
    with workspace(warehouse.spark):
        parsed = materialise(readers.read_parsed(warehouse.spark, path, spec, format, **options), "parsed")
        rows = readers.accepted(parsed)
        warehouse.append(spec, rows) if add else warehouse.replace(spec, rows)
        warehouse.write_staging(rejected_table(spec.name), readers.rejected(parsed))
    return check_rejected(warehouse, spec.name)


def check_rejected(warehouse: Warehouse, table: str) -> DataFrame:
    """How many records of the last ingest of a table were rejected; a warning."""
    return quality.check_rejected(table, warehouse.table(f"{STAGING}.{rejected_table(table)}"))
