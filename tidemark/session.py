"""Session settings and the shared work folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Set on every session; results depend on them.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

#: Used only by sessions this package builds itself.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; ``conf`` entries (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; everything else stays as the session has it."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: Work folders made by each Spark application, until released; a local application's own root.
_made: dict[str, list[str]] = {}
_roots: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a local-mode application, all of whose tasks run on this machine, gets one
    folder of its own, removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = tempfile.TemporaryDirectory(prefix="tidemark-")
    return _roots[app].name


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the work folders that this application has made, the first ``since`` excepted.

    For a caller that has written out, or no longer needs, what reads from them.
    """
    paths = _made.get(spark.sparkContext.applicationId, [])
    _delete(spark, paths[since:])
    del paths[since:]


def _delete(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)


def mark(spark: SparkSession) -> int:
    """The number of work folders so far, for :func:`stage_last` or :func:`release`."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def stage_last(df: DataFrame, label: str, since: int) -> DataFrame:
    """:func:`stage` a result whose inputs nobody needs any more: the work folders made after
    ``since`` (see :func:`mark`) are deleted once it is written."""
    spark = df.sparkSession
    result = stage(df, label)
    paths = _made[spark.sparkContext.applicationId]
    _delete(spark, paths[since:-1])
    del paths[since:-1]
    return result


@contextmanager
def work(spark: SparkSession) -> Iterator[None]:
    """Work folders made inside the block are deleted at its end."""
    before = mark(spark)
    try:
        yield
    finally:
        release(spark, before)


@contextmanager
def dealt(spark: SparkSession, parts: int) -> Iterator[None]:
    """Shuffles that run inside the block have ``parts`` partitions, or the session's number where
    that is larger: what a task sorts then does not grow with the table."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, max(int(before), parts))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def dealt_session(spark: SparkSession, parts: int) -> SparkSession:
    """A session like ``spark`` as it is now, whose shuffles have ``parts`` partitions, or as many as
    those of ``spark`` where they are more: like :func:`dealt`, for results that run later."""
    key = "spark.sql.shuffle.partitions"
    own = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set(key, max(int(spark.conf.get(key)), parts))
    return own


def stage_buckets(df: DataFrame, label: str, column: str, codec: str | None = None,
                  buckets: int | None = None) -> DataFrame:
    """:func:`stage` in ``buckets`` by ``column``, else as many as the session has shuffle
    partitions: a join on that column takes them as they are, so that only its other side moves.

    Each task writes a file per bucket it holds rows of; rows that come out of a shuffle by
    ``column`` give one file per bucket.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tidemark_{label}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    writer = df.write.format("parquet").bucketBy(buckets, column).option("path", path)
    (writer.option("compression", codec) if codec else writer).saveAsTable(name)
    return spark.table(name)


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder once and read it back.

    For results that several later steps use. Column pruning gives each use its own plan, so
    Spark would compute them again for every one; a written table also outlives lost executors.
    It stays until :func:`release`, or the end of a :func:`work` block. ``codec`` compresses the
    files in another way than the session does.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
