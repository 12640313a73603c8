"""The run log: one row per finished step, and what can be told from it."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starload.local import small_frame
from starload.operators.quality import FAIL, PASS, WARN, roll_up

# Step outcomes, stages and the texts of a run status.
SUCCESS, FAILURE = "success", "failure"
READ, PROCESS, WRITE, VALIDATE = "read", "process", "write", "validate"
TEXT_COMPLETED = "{n} step(s) completed successfully"
TEXT_NOT_RUN = "not yet run"

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("step_hash", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


@dataclass(frozen=True)
class StepRecord:
    run_id: str
    seq: int
    table: str
    stage: str
    start_time: datetime.datetime
    end_time: datetime.datetime
    status: str
    rows_affected: int | None
    step_hash: str
    error_message: str | None = None

    def row(self) -> tuple:
        values = list(astuple(self))
        values.insert(6, (self.end_time - self.start_time).total_seconds())
        return tuple(values)


def log_rows(spark: SparkSession, records: Sequence[StepRecord]) -> DataFrame:
    return small_frame(spark, [r.row() for r in records], RUN_LOG)


def summarise_runs(log: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Steps per run, the tables they were about, and how many succeeded and failed."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("steps"),
        F.array_join(F.sort_array(F.collect_set("table")), ",").alias("tables"),
        F.count_if(F.col("status") == SUCCESS).alias("succeeded"),
        F.count_if(F.col("status") == FAILURE).alias("failed"))


def _loads() -> Column:
    """Whether a row is a step of a load; checks that ran to their end are logged and are none."""
    return (F.coalesce(F.col("stage"), F.lit("")) != VALIDATE) | (F.col("status") == FAILURE)


def run_status(log: DataFrame) -> DataFrame:
    """Per run: FAIL with its first failed step, else PASS with the number of steps."""
    step = F.struct(F.concat_ws(".", "table", "stage").alias("step"), F.col("error_message").alias("error"))
    failed = F.col("status") == FAILURE
    runs = log.groupBy("run_id").agg(
        F.count_if(_loads()).alias("steps"), F.count_if(failed).alias("failed"),
        F.min_by(step, F.when(failed, F.col("seq"))).alias("first"))
    bad = F.col("failed") > 0
    done = F.concat(F.col("steps").cast("string"), F.lit(TEXT_COMPLETED.partition("{n}")[2]))
    told = F.concat(F.col("first.step"), F.lit(" failed: "), F.coalesce(F.col("first.error"), F.lit("")))
    return runs.select("run_id", F.when(bad, FAIL).otherwise(PASS).alias("status"),
                       F.when(bad, told).otherwise(done).alias("detail"), "steps", "failed")


def latest_run_status(log: DataFrame) -> DataFrame:
    """Status of the run that started last; WARN while nothing has run."""
    last = log.agg(F.max_by("run_id", F.struct("start_time", "seq"))).scalar()
    status = run_status(log.where(F.col("run_id") == last))
    told = status.agg(F.max("run_id").alias("run_id"), F.max("status").alias("status"),
                      F.max("detail").alias("detail"))
    return told.select("run_id", F.coalesce("status", F.lit(WARN)).alias("status"),
                       F.coalesce("detail", F.lit(TEXT_NOT_RUN)).alias("detail"))


def year_and_quarter(moment: Column) -> list[Column]:
    """Columns `year` and `quarter` (Q1 to Q4) of a date or timestamp."""
    return [F.year(moment).alias("year"), F.concat(F.lit("Q"), F.quarter(moment)).alias("quarter")]


def event_record(log: DataFrame, report: DataFrame) -> DataFrame:
    """One record per run: its step counts next to the counts and status of its checks.

    Both inputs carry run_id and status, the log also stage and start_time.  The
    result has year and quarter to be partitioned by when written.
    """
    steps = log.groupBy("run_id").agg(
        F.min("start_time").alias("started"), F.count_if(_loads()).alias("steps"),
        F.count_if((F.col("status") == SUCCESS) & _loads()).alias("succeeded"),
        F.count_if(F.col("status") == FAILURE).alias("failed"))
    checks = roll_up(report, ["run_id"]).withColumnRenamed("status", "validation")
    both = steps.join(checks, "run_id", "left")
    return both.select(*year_and_quarter(F.col("started")), *both.columns)
