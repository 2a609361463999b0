"""Session helpers: the shared folder for stage tables, and reuse of stages within one application."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL_DIRS: dict[str, str] = {}
_STAGES: dict[tuple[str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so the missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="reviewloom-")
    return _LOCAL_DIRS[app]


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate relation to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/reviewloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_path(spark: SparkSession, dataset: str, name: str) -> str:
    digest = hashlib.md5(dataset.rstrip("/").encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/reviewloom/{spark.sparkContext.applicationId}/{digest}/{name}"


def stage(
    spark: SparkSession, dataset: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Land ``build()`` once per application and dataset, and read it back.

    Landing a stage cuts its lineage with files that outlive any executor, so the many views
    over the same stage scan it instead of recomputing it.
    """
    path = stage_path(spark, dataset, name)
    key = (spark.sparkContext.applicationId, path)
    if key not in _STAGES:
        df = build()
        df.write.mode("overwrite").parquet(path)
        _STAGES[key] = df.schema.json()
    return spark.read.schema(_schema(_STAGES[key])).parquet(path)


def table_stage(
    spark: SparkSession, dataset: str, name: str, write: Callable[[str, str], None]
) -> DataFrame:
    """Like :func:`stage`, as a catalog table that keeps its buckets; ``write`` gets its name and path."""
    path = stage_path(spark, dataset, name)
    table = f"reviewloom_{name}_{hashlib.md5(path.encode()).hexdigest()[:12]}"
    key = (spark.sparkContext.applicationId, path)
    if key not in _STAGES:
        write(table, path)
        _STAGES[key] = table
    return spark.table(table)


@contextmanager
def wide_rows(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Fewer rows per batch of a Parquet scan for the actions inside: a row that holds a review's pairs may
    take tens of megabytes, and a scan keeps as many rows as a batch has in vectors of their size."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def forget_stages() -> None:
    """Make the next use of every stage rebuild it (benchmarks measure cold builds)."""
    _STAGES.clear()


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
