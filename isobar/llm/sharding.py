"""Sharding over fixed virtual slots (operator 1), DataFrame functions only.

Every record hashes into one of a few thousand virtual slots, for good. A
small versioned table maps slots to shards. Bytes are added up per slot, and
rebalancing edits the map: it moves whole slots from full shards to the
emptiest, so a record changes its shard only when its slot was moved. The
number of slots bounds everything that is not row-parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import numbered, staged
from isobar.session import scratch_path

SLOTS = 4096


def _told_apart(rows: DataFrame, stage: str) -> DataFrame:
    """``rows`` with ``_copy``, the row's number among equal ``doc_id, text_crc32, size``, from 0. Rows get
    their place in the table when they are staged, so equal rows are numbered
    side by side, however many there are."""
    rows = staged(rows.withColumn("_id", F.monotonically_increasing_id())
                  .withColumn("_key", F.xxhash64("doc_id", "text_crc32", "size")), stage)
    rows = rows.withColumn("_task", F.shiftright("_id", 33))  # at most as many as tasks that staged
    return numbered(rows, ["_key"], "_task", [F.col("_id")], "_copy").drop("_key", "_task", "_id")


def _slot(n_slots: int) -> Column:
    # the first of equal rows stays where it is when copies come
    copy = F.when(F.col("_copy") > 0, F.col("_copy"))
    return F.pmod(F.xxhash64("doc_id", "text_crc32", copy), F.lit(n_slots)).cast("int")


def _sized(documents: DataFrame, *more: Column) -> DataFrame:
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("bigint"))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint")
    return documents.select("doc_id", size.alias("size"), crc.alias("text_crc32"), *more)


def records(documents: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)`` of each document.

    ``size`` is the text's UTF-8 bytes plus 8 (NULL text: 8), ``text_crc32``
    the unsigned CRC-32 of those bytes (NULL and empty text: 0). The slot
    depends on doc_id and text, and on the number among equal rows, so that
    repeated rows spread like others; NULL doc_ids spread by their text.
    """
    return _told_apart(_sized(documents), "shard-records").withColumn("virtual_slot", _slot(n_slots)).drop("_copy")


def first_map(spark: SparkSession, n_shards: int, n_slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map ``(version, virtual_slot, shard)``: slots dealt in turn."""
    return spark.range(n_slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % n_shards).cast("int").alias("shard"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes per virtual slot; partial sums, so a slot's rows never meet."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))


def rebalance(slot_map: DataFrame, sizes: DataFrame, n_shards: int, passes: int = 2) -> DataFrame:
    """The next version of ``slot_map``, edited so that shards 0..n_shards-1
    hold near equal bytes.

    Slots are visited from the largest to the smallest; a slot moves to the
    shard that is emptiest at that moment if its own shard is above the mean
    and the move leaves the fuller of the two below what its shard held
    before. Slots of a shard that no longer exists always move. Ties go to
    the smaller slot and shard. The fold is over the map's slots (a fixed,
    small number), not over records.
    """
    out = slot_map
    for last in [False] * (passes - 1) + [True]:
        out = _edit(out, sizes, n_shards, last)
    return out


def _edit(slot_map: DataFrame, sizes: DataFrame, n_shards: int, bump: bool) -> DataFrame:
    held = (slot_map.join(sizes, "virtual_slot", "left")
            .select("version", F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"),
                    (-F.col("virtual_slot")).alias("minus_slot"), "shard"))
    # largest first, then the smaller slot
    one = held.agg(F.max("version").alias("version"),
                   F.sort_array(F.collect_list(F.struct("bytes", "minus_slot", "shard")),
                                asc=False).alias("items"))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.aggregate(F.filter("items", lambda x: x["shard"] == s),
                              F.lit(0).cast("bigint"), lambda a, x: a + x["bytes"]))
    mean = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x["bytes"]) / n_shards
    one = one.withColumn("loads", loads).withColumn("mean", mean)

    def move(acc, x):
        low = F.array_min(acc["loads"])
        here = F.get(acc["loads"], x["shard"])
        moves = (x["shard"] >= n_shards) | ((here > acc["mean"]) & (low + x["bytes"] < here))
        to = (F.array_position(acc["loads"], low) - 1).cast("int")
        # one-element array: the shard is worked out once, not for every load
        goal = F.array(F.when(moves, to).otherwise(x["shard"]))
        return F.get(F.transform(goal, lambda g: F.struct(
            F.transform(acc["loads"], lambda v, i: v + x["bytes"] * (
                (i == g).cast("bigint") - (i == x["shard"]).cast("bigint"))).alias("loads"),
            acc["mean"].alias("mean"),
            F.concat(acc["placed"], F.array(F.struct((-x["minus_slot"]).alias("virtual_slot"),
                                                     g.alias("shard")))).alias("placed"))), F.lit(0))

    start = F.struct(F.col("loads").alias("loads"), F.col("mean").alias("mean"),
                     F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("placed"))
    placed = one.select("version", F.explode(F.aggregate("items", start, move)["placed"]).alias("p"))
    return placed.select((F.col("version") + int(bump)).alias("version"), "p.virtual_slot", "p.shard")


def save_map(slot_map: DataFrame, path: str) -> None:
    """Append a version of the map to the stored versions."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the newest if none is named."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version).select("version", "virtual_slot", "shard")


def assign(documents: DataFrame, slot_map: DataFrame | None = None, n_shards: int = 24,
           n_slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Put every document into a shard.

    Returns ``doc_id, size, text_crc32, law ('bytes'), shard, slot,
    grown_shard (NULL), virtual_slot, map_version``. ``slot`` is the row's place in its
    shard, from 0 without gaps. With no ``slot_map`` the first map is
    rebalanced for these documents, and both versions are stored at ``map_path``
    (default: a scratch folder); pass a stored map to keep it as it is.

    Sizes follow the law ``bytes``: no shard is above the mean by more than
    about the largest slot, which is near the largest document: copies of
    a row lie in different slots. An empty table gives no rows; repeated rows
    count and are placed one by one; other columns are ignored.
    """
    spark = documents.sparkSession
    rows = staged(records(documents, n_slots), "shard-slots")
    if slot_map is None:
        map_path = map_path or scratch_path(spark, "slot-map")
        save_map(first_map(spark, n_shards, n_slots), map_path)
        save_map(rebalance(load_map(spark, map_path), slot_bytes(rows), n_shards), map_path)
        slot_map = load_map(spark, map_path)
    # the map has n_slots rows, so it is safe to broadcast
    placed = rows.join(F.broadcast(slot_map.withColumnRenamed("version", "map_version")),
                       "virtual_slot")
    out = numbered(placed, ["shard"], "virtual_slot",
                   [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def shards(documents: DataFrame, slot_map: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """``documents`` with their ``shard``, e.g. to be written by shard; the
    shard column replaces one of that name. Rows are carried as one struct, so
    other names do not clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    rows = _told_apart(_sized(documents, row), "shard-rows").withColumn("virtual_slot", _slot(n_slots))
    small = F.broadcast(slot_map.select("virtual_slot", F.col("shard").alias("_shard")))  # n_slots rows
    kept = [F.col(f"_row.`{c}`").alias(c) for c in documents.columns if c != "shard"]
    return rows.join(small, "virtual_slot").select(*kept, F.col("_shard").alias("shard"))


__all__ = ["SLOTS", "records", "first_map", "slot_bytes", "rebalance", "save_map", "load_map",
           "assign", "shards"]
