"""The shared folder where intermediate results are written.

Results that must not change between two reads of them (partition numbers,
staged rows) are written as parquet, which cuts the lineage and survives the
loss of executors.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from starload.classic import hadoop, is_alive

_local_folders: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_folders:
        own = tempfile.mkdtemp(prefix="starload-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _local_folders.append(own)
    return _local_folders[0]


def fresh_path(spark: SparkSession, label: str, *, owned: bool = False) -> str:
    """A path under the shared folder that nothing has been written to yet; an `owned` one goes when the driver ends."""
    path = f"{scratch_root(spark)}/starload/{label}-{uuid.uuid4().hex}"
    if owned:
        _of_driver(spark).paths.append(path)
    return path


class Workspace:
    """The files that one run writes to the shared folder; nobody else's are removed with them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    @contextlib.contextmanager
    def active(self) -> Iterator[Workspace]:
        """What this thread materialises inside belongs to this workspace."""
        before = _active.set(self)
        try:
            yield self
        finally:
            _active.reset(before)

    def close(self) -> None:
        paths, self.paths = self.paths, []
        remove(self.spark, paths)


_active: contextvars.ContextVar[Workspace | None] = contextvars.ContextVar("workspace", default=None)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and return a reader of what was written.

    The files belong to the active workspace and go with it; without one they
    stay until the driver ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    (_active.get() or _of_driver(spark)).paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_owners: weakref.WeakKeyDictionary[SparkSession, Workspace] = weakref.WeakKeyDictionary()


def _of_driver(spark: SparkSession) -> Workspace:
    """What is kept until the driver ends."""
    if spark not in _owners:
        _owners[spark] = Workspace(spark)
        atexit.register(_forget, _owners[spark])
    return _owners[spark]


def _forget(owner: Workspace) -> None:
    """At the end of the driver, as long as Spark is still there to delete with."""
    with contextlib.suppress(Exception):
        if is_alive(owner.spark):
            owner.close()


@contextlib.contextmanager
def workspace(spark: SparkSession) -> Iterator[Workspace]:
    """Deletes at its end what this thread materialised inside; results must be written by then."""
    own = Workspace(spark)
    try:
        with own.active():
            yield own
    finally:
        own.close()


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        place, files = hadoop(spark, path)
        files.delete(place, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    place, files = hadoop(spark, path)
    return [f.getPath().toString() for f in files.listStatus(place)] if files.exists(place) else []
