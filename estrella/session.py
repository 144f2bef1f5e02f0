"""Session settings and written intermediates shared by all operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
_ROWS_A_TASK = 1_000_000
# codec of stored tables and intermediates
CODEC = "zstd"


def build_session(app_name: str = "estrella", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="estrella-")
    return _local_dirs[app]


_scope: ContextVar[str] = ContextVar("scope", default="")


def work_path(spark: SparkSession, name: str | None = None) -> str:
    root = f"{shared_dir(spark)}/estrella/{spark.sparkContext.applicationId}{_scope.get()}"
    return f"{root}/{name or uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside are deleted at the end; no frame that reads them may be used later."""
    token = _scope.set(f"{_scope.get()}/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, work_path(spark, "x").rpartition("/")[0])
        _scope.reset(token)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: the lineage ends here and survives lost executors."""
    return materialize_counted(df)[0]


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialize`` plus the row count, observed during the write instead of by a second scan."""
    seen = Observation()
    path = work_path(df.sparkSession)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def release_materialized(spark: SparkSession) -> None:
    """Delete the intermediates this application wrote."""
    _delete(spark, work_path(spark, "x").rpartition("/")[0])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fit_partitions(spark: SparkSession, rows: int) -> None:
    """Raise the session's shuffle partitions, never lower them, so that a task sorts about a million of ``rows``.

    With a number that does not follow the rows, the sorts and maps of a task outgrow its memory and spill. Adaptive
    execution merges what turns out small.
    """
    wanted = -(-rows // _ROWS_A_TASK)
    if wanted > shuffle_partitions(spark):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
