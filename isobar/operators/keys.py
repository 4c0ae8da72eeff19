"""Keyed deduplication: newest version per key (W1-W3) and top-n per key.

All of them are ``row_number()`` over a window partitioned by the key.
Catalyst rewrites ``row_number() <= n`` into a *WindowGroupLimit* that runs
once before the shuffle (each map task keeps at most ``n`` rows per key) and
once after it, so a hot key holding a third of the rows still ships only
``n`` rows per map task across the network. The ordering is made total with
an explicit tiebreak so results are deterministic (the reference leaves ties
arbitrary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from isobar.session import staged

RANK_COL = "_rk"


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Columns usable as a tiebreak (map types have no order)."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, T.MapType)]


def _desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def _asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def top_n(df: DataFrame, keys: Sequence[str], n: int,
          desc: Sequence[str | Column] = (), asc: Sequence[str | Column] = (),
          tiebreak: Sequence[str] | None = None, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in (``desc`` descending, then ``asc``
    ascending, then ``tiebreak`` descending) order.

    ``tiebreak=None`` uses every other orderable column, which makes the
    order total. ``rank_col`` keeps the 1-based rank under that name.
    """
    used = [*keys, *[c for c in desc if isinstance(c, str)],
            *[c for c in asc if isinstance(c, str)]]
    if tiebreak is None:
        tiebreak = _orderable(df, used)
    order = [*map(_desc, desc), *map(_asc, asc), *map(_desc, tiebreak)]
    w = Window.partitionBy(*keys).orderBy(*order)
    rk = rank_col or RANK_COL
    out = df.withColumn(rk, F.row_number().over(w)).filter(F.col(rk) <= n)
    return out if rank_col else out.drop(rk)


def enforce(df: DataFrame, keys: Sequence[str], version: str = "source",
            tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the one with the highest ``version``.

    Used on every normalised table so a later delivery of the same key
    replaces the earlier one regardless of arrival order. Idempotent.
    """
    return top_n(df, keys, 1, desc=[version], tiebreak=tiebreak)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
           tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The newest row per key by ``order`` (descending)."""
    return top_n(df, keys, 1, desc=order, tiebreak=tiebreak)


def top_n_by_group(df: DataFrame, keys: Sequence[str], group_order: Column, n: int,
                   asc: Sequence[str | Column] = ()) -> DataFrame:
    """W4 over groups of rows (e.g. forecast issues): the first ``n`` rows
    per key taking whole groups newest first (``group_order`` descending),
    spilling into older groups when the newest is short, rows inside a group
    in ``asc`` order."""
    return top_n(df.withColumn("_g", group_order), keys, n, desc=["_g"], asc=asc,
                 tiebreak=[]).drop("_g")


def needed_groups(counted: DataFrame, keys: Sequence[str], group_order: Column, n: int,
                  count: str = "n") -> DataFrame:
    """The groups that :func:`top_n_by_group` takes rows from, given ``counted``
    rows (several per group, with their ``count``): all those with fewer
    than ``n`` rows in newer groups of the key."""
    newer = (Window.partitionBy(*keys).orderBy(F.col("_g").desc_nulls_last())
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    own = Window.partitionBy(*keys, "_g")
    before = F.sum(count).over(newer) - F.sum(count).over(own)
    return (counted.withColumn("_g", group_order).withColumn("_before", before)
            .filter(F.col("_before") < n).drop("_g", "_before"))


# Bits of the filter that every task gets: eight for a wanted key, between these (32 MB).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_BLOCK = 1 << 15  # bits in a row of it


def perhaps_in(df: DataFrame, wanted: DataFrame, cols: Sequence[str], unless: Column | None = None) -> DataFrame:
    """The rows of ``df`` whose ``cols`` are in ``wanted``, and few others (at eight bits a key an eighth of them at
    most): a filter of bounded size is sent to the tasks, so that a join that follows shuffles little.
    Both sides must have the same types; ``wanted`` is read twice. Rows for which ``unless`` holds stay."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, 8 * wanted.count()):
        bits *= 2
    at = F.xxhash64(*cols).bitwiseAND(F.lit(bits - 1))
    block, word, bit = F.shiftright(at, 15), F.shiftright(at, 6).bitwiseAND(F.lit(_BLOCK // 64 - 1)), at.bitwiseAND(F.lit(63))
    shifted = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    words = (wanted.select(block.alias("_block"), word.cast("int").alias("_word"), bit.cast("int").alias("_bit"))
             .groupBy("_block", "_word").agg(F.bit_or(shifted).alias("_bits")))
    found = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_map"))
    filled = staged(found.select("_block", F.transform(F.sequence(F.lit(0), F.lit(_BLOCK // 64 - 1)), lambda i: F.coalesce(
        F.try_element_at("_map", i), F.lit(0).cast("bigint"))).alias("_words")), "filter")
    hit = F.getbit(F.get("_words", word.cast("int")), bit.cast("int")) == 1
    hit = F.coalesce(hit, F.lit(False))
    return (df.join(F.broadcast(filled.withColumnRenamed("_block", "_in")), block == F.col("_in"), "left")
            .filter(hit if unless is None else hit | unless).drop("_in", "_words"))


def running(df: DataFrame, order: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """All rows in the order of the columns ``order``, with a bigint column for each of ``totals``: the sum of
    its expression over all rows before. One range-partitioned sort, staged;
    only the totals of partitions are added up in one place."""
    s = staged(df.withColumns({f"_of_{n}": c.cast("bigint") for n, c in totals.items()})
               .repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()), "running")
    # the id is the partition in the upper bits, the place in it in the lower 33
    s = s.withColumn("_p", F.shiftright("_id", 33))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (s.groupBy("_p").agg(*[F.sum(f"_of_{n}").alias(f"_sum_{n}") for n in totals])
              .select("_p", *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_start_{n}")
                              for n in totals]))
    inside = Window.partitionBy("_p").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    out = s.join(starts, "_p").withColumns({
        n: F.col(f"_start_{n}") + F.coalesce(F.sum(f"_of_{n}").over(inside), F.lit(0)) for n in totals})
    return out.drop("_id", "_p", *[f"{x}{n}" for n in totals for x in ("_of_", "_start_")])


def number_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows from 0 without gaps in the order of the columns
    ``order``: one range-partitioned sort, staged; only one count per
    partition is added up in one place."""
    s = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()), "number-rows")
    # the id is the partition in the upper bits, the place in it in the lower 33
    s = s.withColumn("_p", F.shiftright("_id", 33))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (s.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
              .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (s.join(starts, "_p").withColumn(name, F.col("_start") + place)
            .drop("_start", "_id", "_p"))
