"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "fathom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on; callers may override any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Folder of the job that runs now, if it is one that clears up after itself.
_JOB: ContextVar[str | None] = ContextVar("fathom_job", default=None)


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="fathom-")  # a local run or a test: one machine
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def shared_dir(spark: SparkSession, keep: bool = False) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    It goes with the job (``job_scratch``) or else with the application: results that are
    still to be read stay readable. ``keep``: it stays.
    """
    root = _shared_root(spark)
    name = uuid.uuid4().hex
    if keep:
        return f"{root}/kept/{name}"
    if _JOB.get():
        return f"{_JOB.get()}/{name}"
    application = f"{root}/{spark.sparkContext.applicationId}"
    where, fs = _folder(spark, application)
    if not fs.exists(where):
        fs.mkdirs(where)
        fs.deleteOnExit(where)
    return f"{application}/{name}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """What is written to shared folders inside is deleted at the end, failed or not.

    For jobs whose results are written elsewhere or are plain numbers.
    """
    path = shared_dir(spark)
    token = _JOB.set(path)
    try:
        yield path
    finally:
        _JOB.reset(token)
        where, fs = _folder(spark, path)
        fs.delete(where, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from files, so a lost executor never replays what came before, and
    values such as partition ids stay what they were when written.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a task that sorts narrow rows.
TASK_ROWS = 1_000_000


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Tasks for a shuffle of ``df``, so that none gets more rows as ``df`` grows.

    Counting reads footers of Parquet files only if ``df`` neither filters nor joins them.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
