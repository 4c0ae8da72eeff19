"""Mixing sources to target weights by systematic sampling (operator 5).

Every document of a source is expected to be taken ``rate`` times. Expected
copies are added up along the source's documents, one random offset is
added, and a document is emitted once for every integer that its stretch of
the sum crosses. Documents are put in order of size within their source
first, so that the draw is spread over all sizes and the words taken come
near the target.

Where a few large documents hold much of a source, a single offset may still miss
its target by one of them. So several offsets are drawn for each source, and
the one whose words come nearest is used. A document is then no longer taken with
exactly its rate over all seeds: with few documents, sets that fit the
target are preferred. With many, all offsets are about as near.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import global_order, staged, word_count

# Rates are kept as whole multiples of 2^-26: boundaries are exact integers,
# so no rounding can give a document one copy too many.
SCALE = 1 << 26
OFFSETS = 24  # drawn for each source


def targets(sources: DataFrame, cap: float = 3.0, weights=(1, 2, 3), share: float = 1.0) -> DataFrame:
    """Target words of each source.

    ``sources`` has ``source`` (may be NULL) and ``source_size``. Sources in
    code point order, NULL last, weigh ``weights`` in turn and share
    ``share`` times all words by weight. No target exceeds ``cap`` times its
    source's words: what is above is shared again by weight among the
    others until none is above. Returns the input with ``target`` double.
    Only sums go through the driver.
    """
    null_last = F.col("source").isNull().cast("int")
    ranked = global_order(sources.withColumn("_null", null_last), ["_null", "source"], "_rank",
                          "mix-sources").drop("_null")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_rank") % len(weights) + 1).cast("int"))
    s = staged(ranked.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(cap))),
               "mix-weights")
    total = (s.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = None, -1
    while True:  # the set of sources at their cap only grows
        full = F.lit(False) if level is None else F.col("_cap") <= level * F.col("_w")
        row = s.agg(F.count(F.when(full, 1)).alias("n"),
                    F.sum(F.when(full, F.col("_cap"))).alias("fixed"),
                    F.sum(F.when(~full, F.col("_w"))).alias("w")).first()
        if row.n == capped or not row.w:
            break
        capped, level = row.n, (total - (row.fixed or 0.0)) / row.w
    goal = F.least(F.col("_cap"), F.lit(float(level or 0.0)) * F.col("_w"))
    return s.withColumn("target", goal.cast("double")).drop("_w", "_cap", "_rank")


def mix(rows: DataFrame, seed: int = 11, cap: float = 3.0, weights=(1, 2, 3)) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to ``rows``, which have
    ``doc_id, source, size`` and a ``tie`` hash of their content.

    ``copies`` is the rate rounded down or up, at most ``ceil(cap)``. A
    source without words has target 0 and gives no copies. Rows that are
    alike in all four columns are interchangeable. The same rows and seed
    give the same copies whatever the partitions.
    """
    keyed = (rows.withColumn("_null", F.col("source").isNull().cast("int"))
             .withColumn("_mixed", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie"))))
    order = ["_null", "source", "size", "_mixed", "doc_id", "tie"]
    placed = global_order(keyed, order, "_place", "mix-rows")
    per_source = placed.groupBy("source").agg(F.sum("size").alias("source_size"),
                                              F.min("_place").alias("_first"))
    goals = staged(targets(per_source, cap, weights), "mix-targets")
    rate = F.when(F.col("source_size") > 0,
                  F.floor(F.col("target") / F.col("source_size") * SCALE + 0.5)).otherwise(0)
    goals = goals.withColumn("_rate", rate.cast("bigint")).withColumnRenamed("source", "_source")
    k = F.col("_place") - F.col("_first")

    def copies(offset: Column) -> Column:
        return (F.shiftright(offset + F.col("_rate") * (k + 1), 26) - F.shiftright(offset + F.col("_rate") * k, 26))

    def offset(i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), F.lit(i), F.col("_source")), F.lit(SCALE))

    same = F.col("source").eqNullSafe(F.col("_source"))
    # how far each offset's words are from the target, and the nearest one, the first of equal ones
    tried = (placed.select("source", "size", "_place").join(goals, same).groupBy("_source", "target")
             .agg(*[F.sum(F.col("size") * copies(offset(i))).alias(f"w{i}") for i in range(OFFSETS)]))
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"w{i}") - F.col("target")), F.lit(i), offset(i).alias("_offset"))
                                 for i in range(OFFSETS)]))["_offset"]
    chosen = tried.select(F.col("_source").alias("_of"), best.alias("_offset"))
    goals = staged(goals.join(chosen, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of"), "mix-offsets")
    joined = placed.join(goals, same)
    return (joined.withColumn("copies", copies(F.col("_offset")).cast("int"))
            .drop("_null", "_mixed", "_place", "_first", "_rate", "_offset", "_source"))


def mix_report(documents: DataFrame, seed: int = 11) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every document;
    ``taken`` is the words the mix takes from it, repeats counted. NULL text
    has size 0."""
    # staged: the sort reads its rows twice, to sample and to deal them
    rows = staged(documents.select("doc_id", "source", word_count("text").alias("size"),
                                   F.xxhash64("text").alias("tie")), "mix-sizes")
    return mix(rows, seed).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "copies")


def mixed(documents: DataFrame, seed: int = 11) -> DataFrame:
    """The mix itself: each document as often as it is taken, all its columns
    kept. Columns whose names clash with the working ones are safe: the
    row is carried as one struct."""
    rows = documents.select("doc_id", "source", word_count("text").alias("size"),
                            F.xxhash64("text").alias("tie"),
                            F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    taken = mix(rows, seed).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
