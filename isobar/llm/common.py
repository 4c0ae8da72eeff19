"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.session import scratch_path

# White space separates words; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes of one Arrow batch sent to Python, which is held whole: keeps
# the memory of a worker and its executor bounded when texts are long.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Make a session ready for this folder's Python functions.

    Arrow batches hold at most ``rows`` rows and about ``ARROW_BYTES`` (or one
    row), and Python workers find this package where the driver does (a
    cluster whose nodes do not have it at the same path gets it by
    ``--py-files``).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts
    lineage so that a lost executor recomputes nothing before this point,
    and later passes read only the columns they use. ``session.clear_scratch``
    removes it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """At most ``n`` rows: those with the smallest hashes of ``cols``.

    Rows are thinned by another hash to about ``4 n`` before they meet, so
    what one task reads does not grow with the table.
    """
    share = min(1.0, 4 * n / max(df.count(), 1))
    return (df.filter(thinned(share, *cols))
            .orderBy(F.xxhash64(F.lit("rank"), *cols), *cols).limit(n))


def thinned(share, *cols: str) -> Column:
    """True for about ``share`` (a number or column) of the values of ``cols``."""
    place = F.pmod(F.xxhash64(F.lit("thin"), *cols), F.lit(1 << 30))
    return place < (share if isinstance(share, Column) else F.lit(share)) * (1 << 30)


def word_count(text) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def numbered(rows: DataFrame, keys: Sequence[str], sub: str, order: Sequence[Column],
             name: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in (``sub``, ``order``)
    order, as bigint column ``name``.

    No task holds a whole key: rows are numbered within (keys, sub), and the
    counts per (keys, sub) give each sub-group its start. ``sub`` is a column
    with a bounded number of values per key that spreads the key's rows.
    Keys and ``sub`` must not be NULL. ``rows`` is read twice, so pass a
    staged table when it is dear to compute.
    """
    by = [*keys, sub]
    before = (Window.partitionBy(*keys).orderBy(sub)
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
              .select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return (rows.withColumn("_within", within).join(starts, by)
            .withColumn(name, (F.col("_start") + F.col("_within")).cast("bigint"))
            .drop("_start", "_within"))


def global_order(rows: DataFrame, order: Sequence[str], name: str, stage: str) -> DataFrame:
    """Sort ``rows`` over the whole cluster by the columns ``order``, stage
    them, and number them from 0 without gaps as bigint column ``name``.

    One range-partitioned sort; only one count per partition is added up in
    one place.
    """
    spark = rows.sparkSession
    # a monotonically increasing id is the partition number in the upper bits
    # and the row's place in that partition in the lower 33
    s = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()), stage)
    s = s.withColumn("_p", F.shiftright("_id", 33))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(s.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")), stage + "-counts")
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (s.join(F.broadcast(starts), "_p")  # one row per partition
            .withColumn(name, F.col("_start") + place).drop("_start", "_id", "_p"))
