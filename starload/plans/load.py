"""A run: every build spec read, processed and written, checked and logged."""

from __future__ import annotations

import datetime
import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starload.functions.library import TEXT_HASH_PREFIX
from starload.functions.registry import FunctionRegistry
from starload.local import small_frame
from starload.operators import load, quality, runlog
from starload.operators.lookup import overlapping_versions
from starload.plans import reconcile
from starload.plans.build import Mapper, resolve, stage
from starload.plans.ingest import check_rejected, rejected_table
from starload.scratch import Workspace, materialise
from starload.sources.warehouse import ANALYTICS, RAW, STAGING, Warehouse
from starload.spec import LOOKUP, SEQUENCE, BuildSpec, SpecError, TableSpec

REPORT_TABLE = f"{ANALYTICS}.dq_report"
LOG_TABLE = f"{ANALYTICS}.run_log"
COUNT = T.StructType([T.StructField("n", T.LongType())])
EVENT_TABLE = f"{ANALYTICS}.event_record"
RANGES_TABLE = f"{ANALYTICS}.loaded_ranges"
# Fixed value: what stands for all earlier runs where their fingerprints had to be made again.
EARLIER = "@earlier"


class StepFailed(RuntimeError):
    """A step of a run failed; the run stops there and the log says where."""


@dataclass
class LoadRun:
    """Runs build specs in the order given, parents before children."""

    warehouse: Warehouse
    sources: Mapping[str, TableSpec]
    registry: FunctionRegistry
    run_timestamp: datetime.datetime
    run_id: str = ""

    def __post_init__(self) -> None:
        self.run_id = self.run_id or uuid.uuid4().hex
        self.spark = self.warehouse.spark
        self.records: list[runlog.StepRecord] = []
        self.late: dict[str, DataFrame] = {}
        self.workspace = Workspace(self.spark)
        self.checked: set[tuple] = set()

    def run(self, specs: Sequence[BuildSpec], *, validate: bool = True) -> DataFrame:
        """Load all targets and return the report; the first failure stops the run.

        Every step is in the run log as soon as it has ended, the report when all loads are done.
        """
        try:
            return self._run(specs, validate)
        finally:
            self.workspace.close()

    def _run(self, specs: Sequence[BuildSpec], validate: bool) -> DataFrame:
        for spec in specs:
            self.load(spec)
        if not validate:
            return small_frame(self.spark, [], quality.REPORT)
        today, started = self._now_column().cast("date"), _now()
        try:
            with self.workspace.active():
                self.warehouse.report_of_run(REPORT_TABLE, self.validate(specs), {
                    "run_date": self.run_timestamp.date(), "run_id": self.run_id})
        except Exception as error:
            self._record(specs[-1], runlog.VALIDATE, started, None, error)
        self._record(specs[-1], runlog.VALIDATE, started, None, None)
        # The partition of the day is all that is read of earlier runs' reports.
        written = self.warehouse.table(REPORT_TABLE).where((F.col("run_date") == today) & (F.col("run_id") == self.run_id))
        event = runlog.event_record(runlog.log_rows(self.spark, self.records), written)
        self.warehouse.report_of_run(EVENT_TABLE, event.drop("year", "quarter", "run_id"),
                                     self._quarter(self.records[0].start_time))
        return written

    def _quarter(self, moment: datetime.datetime) -> dict[str, int | str]:
        """The partition of this run in tables that lie by year and quarter."""
        return {"year": moment.year, "quarter": f"Q{(moment.month + 2) // 3}", "run_id": self.run_id}

    # --- one target

    def load(self, spec: BuildSpec) -> None:
        self._step(spec, runlog.READ, lambda: self._read(spec))
        self._step(spec, runlog.PROCESS, lambda: self._process(spec))
        self._step(spec, runlog.WRITE, lambda: self._write(spec))

    def source_frames(self, spec: BuildSpec) -> dict[str, DataFrame]:
        return {t: self.warehouse.table(f"{RAW}.{t}") for t in spec.source_tables}

    def _read(self, spec: BuildSpec) -> int:
        self.warehouse.create_table(spec.target, by_loads=_appends(spec), versions=spec.load_strategy == "scd2")
        sources = self.source_frames(spec)
        if spec.load_strategy == "incremental" and "source_timestamp" in spec.load_options:
            sources[spec.base_table] = self._increment(spec, sources[spec.base_table])
        staged = stage(spec, sources, registry=self.registry, run_timestamp=self.run_timestamp)
        return self.warehouse.write_staging(spec.staging_table, staged)

    def _increment(self, spec: BuildSpec, source: DataFrame) -> DataFrame:
        """The rows to append; those that came too late go to a staging table of their own."""
        target, name = self._before(spec), spec.target.name
        ts, source_ts = spec.load_options["timestamp"], spec.load_options["source_timestamp"]
        found = reconcile.choose_correlation(spec, self.sources[spec.base_table], across_runs=True)
        if found is None:
            self.late[name] = quality.constant_check(
                self.spark, quality.ID_LATE.format(table=name), quality.WARN, quality.TEXT_NO_INCREMENT_KEY, quality.DATA)
            return load.newer_rows(source, target, ts, source_ts)
        source = source.alias(spec.base_table.rpartition(".")[2])
        mapper = Mapper(spec, self.registry, self.run_timestamp)
        keys = {m.target_column: mapper.expression(m) for m in found.mappings}
        loaded, unit = self._loaded(spec, target, list(keys)), _unit(spec)
        self._keep_late(spec, load.older_rows(source, target, ts, keys, source_ts, loaded, unit), quality.TEXT_LATE_APPEND)
        return load.newer_rows(source, target, ts, source_ts, keys, loaded)

    def _before(self, spec: BuildSpec) -> DataFrame:
        """The target without what this very run has appended to it, in case the run is repeated."""
        kept = self.warehouse.versioned(spec.target)
        return kept.rows(without_run=self.run_id) if kept and _appends(spec) else self.warehouse.table(spec.target)

    def _loaded(self, spec: BuildSpec, target: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The fingerprints of what earlier runs appended; made again if they are not those of all rows of target."""
        name, ts = spec.target.name, spec.load_options["timestamp"]
        if self.warehouse.exists(RANGES_TABLE):
            stored = self.warehouse.table(RANGES_TABLE).where((F.col("table") == name) & (F.col("run_id") != self.run_id))
            counted = stored.groupBy("run_id").agg(F.sum(load.ROWS).alias("n")).collect()  # one row per run
            if sum(r["n"] for r in counted) == target.count():
                return stored
            for r in counted:
                empty = small_frame(self.spark, [], stored.drop("table", "run_id").schema)
                self.warehouse.report_of_run(RANGES_TABLE, empty, {"table": name, "run_id": r["run_id"]})
        made = materialise(load.fingerprint(target, ts, {k: k for k in keys}, _unit(spec)), "ranges")
        self.warehouse.report_of_run(RANGES_TABLE, made, {"table": name, "run_id": EARLIER})
        return made

    def _keep_ranges(self, spec: BuildSpec, staged: DataFrame) -> None:
        """After an append: the fingerprint of its rows, in the place of that of an earlier try."""
        found = reconcile.choose_correlation(spec, self.sources[spec.base_table], across_runs=True)
        if found is not None and "source_timestamp" in spec.load_options:
            made = load.fingerprint(staged, spec.load_options["timestamp"], {k: k for k in found.target_columns}, _unit(spec))
            self.warehouse.report_of_run(RANGES_TABLE, made, {"table": spec.target.name, "run_id": self.run_id})

    def _keep_late(self, spec: BuildSpec, rows: DataFrame, detail: str) -> None:
        number = self.warehouse.write_staging(late_table(spec), rows)
        self.late[spec.target.name] = quality.check_late(
            spec.target.name, small_frame(self.spark, [(number,)], COUNT), detail)

    def _dimensions(self, spec: BuildSpec) -> dict[str, DataFrame]:
        return {m.lookup.dimension: self.warehouse.table(f"{spec.target.namespace}.{m.lookup.dimension}")
                for m in spec.columns if m.transformation == LOOKUP}

    def _process(self, spec: BuildSpec) -> int | None:
        """What would go wrong in the write stops the run here, where it can be told.

        That is a value longer than its column, a dimension that repeats a lookup
        key, or one that has two versions for a moment.
        """
        self._check_widths(spec)
        dimensions = self._dimensions(spec)
        for m in spec.columns:
            if m.transformation != LOOKUP:
                continue
            at, keys = m.lookup, [d for _, d in m.lookup.on]
            told = (spec.target.namespace, at.dimension, *keys, *((at.valid_from, at.valid_to) if at.at else ()))
            if told in self.checked:  # once for all columns and specs of a run that look up there
                continue
            dim = dimensions[at.dimension].dropna(subset=keys)
            if at.at:
                if not overlapping_versions(dim, keys, at.valid_from, at.valid_to).isEmpty():
                    raise SpecError(f"{at.dimension} has overlapping versions of ({', '.join(keys)})")
            elif not quality.duplicate_groups(dim, keys).isEmpty():
                raise SpecError(f"{at.dimension} is not unique on ({', '.join(keys)})")
            self.checked.add(told)
        return None

    def _check_widths(self, spec: BuildSpec) -> None:
        staged = self.warehouse.table(f"{STAGING}.{spec.staging_table}")
        widths = {c.name: c.width for c in spec.target.columns if c.width and c.name in staged.columns}
        if widths:
            wide = quality.check_width(spec.target.name, staged, widths).where(F.col("n") > 0)
            found = [f"{r['check_id']}: {r['detail']}" for r in wide.collect()]  # one row per column at most
            if found:
                raise SpecError("; ".join(found))

    def _write(self, spec: BuildSpec) -> int:
        target = self._before(spec)
        staged = self.warehouse.table(f"{STAGING}.{spec.staging_table}")
        rows = resolve(spec, staged, self._dimensions(spec), existing=target, written=True)
        if spec.load_strategy == "full_load":
            return self.warehouse.replace(spec.target, rows)
        if _appends(spec):
            written = self.warehouse.append(spec.target, rows, self.run_id)
            self._keep_ranges(spec, staged)
            return written
        if any(m.transformation == LOOKUP for m in spec.columns):
            # Both strategies read the batch several times; its lookups should run once.
            rows = materialise(rows, spec.target.name)
        if spec.load_strategy == "scd2":
            return self._version(spec, target, rows)
        return self._upsert(spec, target, rows)

    def _version(self, spec: BuildSpec, target: DataFrame, rows: DataFrame) -> int:
        """New versions; rows that come too late are kept in a staging table of their own.  Ended versions are not read."""
        options = spec.load_options
        batch = rows.drop(load.HASHDIFF, load.VALID_TO, load.IS_CURRENT)
        keys, how = options["keys"], (options["keys"], options["tracked"], load.VALID_FROM)
        current = self.warehouse.open_versions(spec.target)
        placed = materialise(load.against_current(current, batch, *how), "placed")
        self._keep_late(spec, load.late_of(placed, batch.columns), quality.TEXT_LATE)
        changed = load.version_rows(placed, target, *how, generated=_sequences(spec))
        if options.get("close_missing", False):
            changed = changed.unionByName(load.ended_versions(current, batch, keys, self._now_column()))
        return self.warehouse.merge(spec.target, materialise(changed, "versions"), [*keys, load.VALID_FROM])

    def _now_column(self) -> Column:
        return F.lit(self.run_timestamp.isoformat(" ")).cast("timestamp_ntz")

    def _upsert(self, spec: BuildSpec, target: DataFrame, batch: DataFrame) -> int:
        keys, order = spec.load_options["keys"], spec.load_options["timestamp"]
        # Several reads follow, so the batch is reduced to one row per key once.
        batch = materialise(load.latest_rows(batch, keys, [order]), "batch")
        batch = load.keep_keys(batch, target, keys, _sequences(spec))
        # Rows can move to another partition, so those of the old versions count as touched too.
        parts = list(spec.target.partition_by)
        found = materialise(load.winners(target, batch, keys, order, parts), "winners")
        old = found.where("_known").select(*[F.col(f"_old_{p}").alias(p) for p in parts])
        return self.warehouse.merge(spec.target, found.select(batch.columns), keys,
                                    found.select(*parts).unionByName(old) if parts else None)

    # --- checks

    def validate(self, specs: Sequence[BuildSpec]) -> DataFrame:
        """Schema, counts, keys, NULLs, references and recomputed columns of all targets."""
        checks = []
        for name in dict.fromkeys(t for s in specs for t in s.source_tables):
            declared = self.sources[name]
            if self.warehouse.exists(f"{STAGING}.{rejected_table(name)}"):
                checks.append(check_rejected(self.warehouse, name))
            checks.append(quality.check_schema(declared, self.warehouse.find(f"{RAW}.{name}"), self.spark, "source"))
        loaded = {s.target.name: self.warehouse.table(s.target) for s in specs}
        for spec in specs:
            name, target = spec.target.name, loaded[spec.target.name]
            checks.append(quality.check_schema(spec.target, target, self.spark, "target"))
            batch = self._of_batch(spec, target)
            staged = self.warehouse.table(f"{STAGING}.{spec.staging_table}")
            if spec.load_strategy == "full_load":
                checks.append(quality.check_row_count(name, staged, target, bool(spec.filters)))
            elif batch is not None:
                keys = self._batch_keys(spec)
                checks.append(quality.check_row_count(name, staged.select(*keys).distinct(), batch.select(*keys).distinct()))
            else:
                checks.append(quality.constant_check(self.spark, quality.ID_ROWCOUNT.format(table=name), quality.WARN,
                                                     quality.TEXT_NO_BATCH_KEY, quality.DATA))
            if spec.grain:
                checks.append(quality.check_unique(name, target, spec.grain, grain=True))
            checks.append(quality.check_table(spec.target, target, loaded))
            if name in self.late:
                checks.append(self.late[name])
            base = self.sources[spec.base_table]
            mapper = Mapper(spec, self.registry, self.run_timestamp)
            sources = self.source_frames(spec)
            if spec.load_strategy != "full_load":
                sources = reconcile.sources_of_batch(spec, base, sources, staged, mapper)
            checks.append(reconcile.check_unparsed(spec, sources, mapper))
            if batch is not None:
                checks.append(reconcile.check_recomputed(
                    spec, base, self._written_now(spec, batch, staged), sources, mapper))
        return quality.union_checks(checks)

    def _batch_keys(self, spec: BuildSpec) -> list[str]:
        """Target columns that the rows of a batch are found again by; none if there are none."""
        if "keys" in spec.load_options:
            return list(spec.load_options["keys"])
        found = reconcile.choose_correlation(spec, self.sources[spec.base_table])
        return list(found.target_columns) if found else []

    def _of_batch(self, spec: BuildSpec, target: DataFrame) -> DataFrame | None:
        """Target rows (current versions) with a key of the last batch; the whole target of a full load; None without keys."""
        if spec.load_strategy == "full_load":
            return target
        keys = self._batch_keys(spec)
        if not keys:
            return None
        staged = self.warehouse.table(f"{STAGING}.{spec.staging_table}")
        if spec.load_strategy == "scd2":
            target = self.warehouse.open_versions(spec.target)
        elif _appends(spec):
            ts = spec.load_options["timestamp"]
            target = target.where(reconcile.not_before(staged, ts, ts, target.schema[ts].dataType))
        return target.join(staged.select(*keys).distinct(), keys, "left_semi").select(target.columns)

    def _written_now(self, spec: BuildSpec, batch: DataFrame, staged: DataFrame) -> DataFrame:
        """Of the rows with a key of the batch those that have its values: a newer row, or an unchanged version, stayed."""
        if spec.load_strategy == "full_load" or "keys" not in spec.load_options:
            return batch
        moment = load.VALID_FROM if spec.load_strategy == "scd2" else spec.load_options["timestamp"]
        keys = [*spec.load_options["keys"], moment]
        return batch.join(staged.select(*keys).distinct(), keys, "left_semi").select(batch.columns)

    # --- log

    def _step(self, spec: BuildSpec, stage_name: str, action) -> None:
        started, rows, error = _now(), None, None
        try:
            with self.workspace.active():
                rows = action()
        except Exception as e:
            error = e
        self._record(spec, stage_name, started, rows, error)

    def _record(self, spec: BuildSpec, stage_name: str, started: datetime.datetime, rows: int | None,
                error: Exception | None) -> None:
        """Append one step to the run log, with the whole text of its error, and stop the run if it failed."""
        text = (str(error) or type(error).__name__) if error else None
        record = runlog.StepRecord(
            self.run_id, len(self.records) + 1, spec.target.name, stage_name, started, _now(),
            runlog.FAILURE if error else runlog.SUCCESS, rows, _step_hash(spec, stage_name), text)
        self.records.append(record)
        try:
            # The first step takes the place of what an earlier try of this run has logged.
            log = runlog.log_rows(self.spark, [record]).drop("run_id")
            self.warehouse.report_of_run(LOG_TABLE, log, self._quarter(self.run_timestamp), renew=len(self.records) == 1)
        finally:
            if error:
                raise StepFailed(f"{spec.target.name}.{stage_name} failed: {text}") from error


def _appends(spec: BuildSpec) -> bool:
    return spec.load_strategy == "incremental" and "keys" not in spec.load_options


def _unit(spec: BuildSpec) -> str:
    """How long a range of time is whose loaded rows have one fingerprint: the load option `range`, or a month."""
    return spec.load_options.get("range", "month")


def _sequences(spec: BuildSpec) -> list[str]:
    return [m.target_column for m in spec.columns if m.transformation == SEQUENCE]


def late_table(spec: BuildSpec) -> str:
    """Staging table of the rows that a versioned load left out."""
    return f"late_{spec.target.name.lower()}"


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


def _step_hash(spec: BuildSpec, stage_name: str) -> str:
    """Fingerprint of what a step was told to do."""
    return TEXT_HASH_PREFIX + hashlib.sha256(f"{stage_name}:{spec!r}".encode()).hexdigest()
