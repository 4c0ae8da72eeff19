"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every isobar job relies on. AQE re-plans joins from runtime sizes
# (the size check behind any broadcast), coalesces small shuffle partitions
# and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The size check behind every broadcast: none is hinted; a side is
    # broadcast only when Spark's estimate (or AQE's runtime size) is below
    # this bound, otherwise the join shuffles (verify.match always does).
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.ui.enabled": "false",
    # remove checkpoint files once the checkpointed data is out of scope
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Rows of a normalised table that one task sorts.
TASK_ROWS = 1 << 20


def get_session(master: str | None = None, app: str = "isobar",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with isobar's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (roughly
    input bytes / 128 MB), AQE coalesces it down at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for staged tables and checkpoints.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local session without one gets a fresh local folder; on a
    cluster the setting is required, since executors do not share disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="isobar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder for ``parts``. Nothing
    else is touched: an earlier result may still be read."""
    app = spark.sparkContext.applicationId
    return "/".join([shared_dir(spark), "isobar", app, *parts, uuid.uuid4().hex])


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch folders; call it when no result that
    reads them is needed any more."""
    from isobar.sources import fs

    fs.delete(spark, f"{shared_dir(spark)}/isobar/{spark.sparkContext.applicationId}")


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to a scratch path and read back: cuts the
    lineage, and later passes read only the columns they use."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.option("compression", compression) if compression else df.write
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`staged`, for as long as the block lasts: nothing read from it may be used later."""
    from isobar.sources import fs

    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs.delete(spark, path)


def tasks_for(rows: int) -> int:
    """Tasks that sort ``rows`` rows in memory."""
    return -(-rows // TASK_ROWS)


__all__ = ["get_session", "shared_dir", "scratch_path", "clear_scratch", "staged", "held", "tasks_for"]
