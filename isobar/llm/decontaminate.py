"""Benchmark decontamination by winnowing (operator 11).

A benchmark item is read in windows of 10 consecutive words (an item of fewer
words is one window). Of every window the ``k``-gram with the smallest hash is
kept, the rightmost of equal ones, with ``k = 5``. The same is done to the
documents. Equal windows keep equal fingerprints, so every span of 10 shared
words is found, whatever surrounds it; neighbouring windows mostly keep the
same k-gram, so a text has about two fingerprints in seven words.

1. Documents keep the fingerprints that pass a filter of fixed size, made from
   the items' fingerprints, with the words of the windows they stand for.
2. They are joined with the items' fingerprints.
3. A hit is extended to the windows around it, and these are joined with the
   items' windows word by word, so nothing rests on hashes.

Equal texts are looked up once. A window that many items share is one row, and
documents with the same windows share one list of items, so a passage that is
common on both sides gives no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import small_batches, staged
from isobar.llm.words import Words, gram_hashes, words

SPAN = 10  # words of a window
GRAM = 5  # words of a fingerprint, at most
FILTER_BITS = 1 << 25  # of the filter that every task gets: 4 MB

CANDIDATE = "struct<n:int,gram:bigint,at:int,many:int,words:array<string>>"


def shape(n: int) -> tuple[int, int]:
    """Words of a gram and grams of a window, for windows of ``n`` words."""
    k = min(GRAM, n)
    return k, n - k + 1


def winnow(h: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of ``n`` words that lie in one text, and the place and
    the hash of the gram that each keeps."""
    k, w = shape(n)
    grams = gram_hashes(h, k)
    starts = np.arange(max(len(h) - n + 1, 0))
    starts = starts[stop[starts] - starts >= n]
    place, least = starts.copy(), grams[starts]
    for j in range(1, w):
        other = grams[starts + j]
        take = other <= least
        place[take], least[take] = starts[take] + j, other[take]
    return starts, place, least.view(np.int64)


def _named(columns: dict, types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types], [c for c, _ in types])


def item_windows(items: DataFrame, span: int = SPAN) -> DataFrame:
    """``item, n, window, gram``: every window of every item with its fingerprint.
    ``n`` is its number of words. Rows of one item_id are one item; a NULL
    item_id is an item named by the empty string; NULL text has no window."""
    small_batches(items.sparkSession)
    types = [("item", pa.string()), ("n", pa.int32()), ("window", pa.string()), ("gram", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {c: [] for c, _ in types}
            for item, w in zip(b.column("item").to_pylist(), _one_by_one(b.column("text"))):
                n = min(span, len(w.hash))
                if n:
                    starts, _, gram = winnow(w.hash, w.stop, n)
                    spelt = w.text(0, len(w.hash))
                    out["item"] += [item] * len(starts)
                    out["n"] += [n] * len(starts)
                    out["window"] += [" ".join(spelt[s:s + n]) for s in starts]
                    out["gram"] += gram.tolist()
            yield _named(out, types)

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    return rows.mapInArrow(run, "item string, n int, window string, gram bigint")


def _one_by_one(texts: pa.Array) -> Iterator[Words]:
    for i in range(len(texts)):
        yield words(texts.slice(i, 1))


def fingerprint_filter(fingerprints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for the low bits of every ``gram``: 64-bit words, at most ``bits / 64`` of
    which come to the driver however many fingerprints there are."""
    at = F.pmod(F.col("gram"), F.lit(bits))
    rows = (fingerprints.groupBy(F.shiftright(at, 6).alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(gram, {bits}) & 63 as int))")).alias("bits")))
    out = np.zeros(bits // 64, np.int64)
    found = rows.toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def candidates(documents: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """``doc_id, n_words, key, found`` of every document: the number of its words, and its
    fingerprints that pass the filter, each with the ``many`` windows from word
    ``at`` on that keep it. ``key`` tells texts apart (128 bits; NULL where nothing was found).
    """
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(bits)

    def passing(gram: np.ndarray) -> np.ndarray:
        table = shared.value
        at = gram.view(np.uint64) & np.uint64(len(table) * 64 - 1)
        return (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            w = words(texts)
            stop = w.stop
            found: list = [[] for _ in range(len(texts))]
            for n in lengths:
                starts, place, gram = winnow(w.hash, stop, n)
                if not len(starts):
                    continue
                # windows in a row that keep the same gram are one fingerprint
                new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1])])
                many = np.diff(np.r_[new, len(starts)])
                keep = passing(gram[new])
                new, many = new[keep], many[keep]
                rows = np.searchsorted(w.first, starts[new], "right") - 1
                for t, s, g, m in zip(rows.tolist(), starts[new].tolist(), gram[new].tolist(), many.tolist()):
                    found[t].append((n, g, s - int(w.first[t]), m, w.text(s, s + m + n - 1)))
            key = [hashlib.blake2b(texts[i].as_buffer(), digest_size=16).digest() if f else None
                   for i, f in enumerate(found)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(w.first)), pa.array(key, pa.binary()),
                 pa.array([[dict(zip(("n", "gram", "at", "many", "words"), x)) for x in f] for f in found], pa.list_(
                     pa.struct([("n", pa.int32()), ("gram", pa.int64()), ("at", pa.int32()), ("many", pa.int32()),
                                ("words", pa.list_(pa.string()))])))], ["doc_id", "n_words", "key", "found"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, key binary, found array<{CANDIDATE}>")


def occurrences(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``key, at, n, window``: every place of every text where an item's window occurs."""
    hits = found.filter("key is not null").select("key", F.explode("found").alias("f")).select("key", "f.*")
    hits = hits.join(windows.select("n", "gram").distinct(), ["n", "gram"], "left_semi")
    places = hits.select("key", "n", "at", "words", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("i"))
    spelt = F.array_join(F.slice("words", F.col("i") + 1, F.col("n")), " ")
    # copies of a text give the same rows
    places = (places.select("key", (F.col("at") + F.col("i")).alias("at"), "n", spelt.alias("window"))
              .groupBy("key", "at", "n").agg(F.first("window").alias("window")))
    return places.join(windows.select("n", "window").distinct(), ["n", "window"])


def report(documents: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    A word is hit if it lies in any occurrence of a window of ``span`` item
    words (of the whole item if it has fewer). ``items_sha256`` is the
    SHA-256 of the sorted item_ids joined by commas, of nothing if there are
    none. NULL and word-less texts have no words and are never contaminated;
    repeated documents count one by one; other columns are ignored. No
    documents: no rows; no items: nothing is hit.
    """
    windows = staged(item_windows(items, span), "leak-windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most ``span`` numbers
    bits = fingerprint_filter(windows.select("gram").distinct())
    rows = staged(candidates(documents, lengths, bits), "leak-candidates")
    found = occurrences(rows, windows)
    # all of one text: no more than its words
    texts = found.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("at", "n"))).alias("places"),
        F.sort_array(F.collect_set("window")).alias("set"))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, p: F.struct(
            F.greatest(a["end"], p["at"] + p["n"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), p["at"] + p["n"] - F.greatest(a["end"], p["at"]))).alias("n")),
        lambda a: a["n"])
    texts = staged(texts.select("key", covered.alias("n_hit"), "set",
                                F.sha2(F.array_join("set", "\n"), 256).alias("sig")), "leak-texts")
    sets = texts.groupBy("sig").agg(F.first("set").alias("set")).select("sig", F.explode("set").alias("window"))
    named = (sets.join(windows.select("window", "item").distinct(), "window")
             .groupBy("sig").agg(F.sort_array(F.collect_set("item")).alias("items")))
    lists = named.select(F.col("sig").alias("_sig"), F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    hit = (texts.join(lists, texts["sig"] == lists["_sig"])
           .select(F.col("key").alias("_key"), "n_hit", "n_items", "items_sha256"))
    # only documents with a candidate are shuffled; the others are done
    some = rows.filter("key is not null").join(hit, F.col("key") == F.col("_key"), "left")
    none = rows.filter("key is null")
    empty = {"n_hit": F.lit(None).cast("bigint"), "n_items": F.lit(None).cast("bigint"),
             "items_sha256": F.lit(None).cast("string")}
    out = ["doc_id", "n_words", *empty]
    both = some.select(*out).union(none.withColumns(empty).select(*out))
    zero = F.lit(0).cast("bigint")
    return both.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                       F.coalesce("n_items", zero).alias("n_items"),
                       F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                       (F.coalesce("n_hit", zero) > 0).alias("contaminated"))


def spans(documents: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """The hits themselves: ``doc_id, at, words, items``, the item_ids of every window of ``words``
    words that occurs from word ``at`` on."""
    windows = staged(item_windows(items, span), "leak-windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())
    rows = staged(candidates(documents, lengths, fingerprint_filter(windows.select("gram").distinct())),
                  "leak-candidates")
    named = windows.groupBy("n", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    places = occurrences(rows, windows).join(named, ["n", "window"])
    return (rows.filter("key is not null").select("doc_id", "key").distinct().join(places, "key")
            .select("doc_id", "at", F.col("n").alias("words"), "items"))
