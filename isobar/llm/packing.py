"""Packing documents into training windows by non-negative least squares
(operator 7).

Documents are cut into whole windows and one rest. The rests' lengths make a
histogram of at most ``window`` entries, and the plan is made on that
histogram alone: combinations of up to three lengths that fill a window exactly
are enumerated, their repeat counts are solved by non-negative least squares
against the histogram and rounded. Where rests are too short for that, combinations of
more lengths are enumerated and solved on what is left, a few times. The
residual is packed greedily.
Rests then look up their place in the plan by (length, number among the
rests of that length), so any number of rests is placed in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import numbered, small_batches, staged
from isobar.llm.tokens import default_paths, encoder

WINDOW = 2048
END = 1  # the id that ends each document
DEEP = 2048  # combinations of more than three lengths that are tried at a time,
DEEP_ROUNDS = 8  # so many times,
DEEP_LEAST = 0.01  # while more than this share of the ids is without a place
GOLDEN, SILVER = 0.6180339887498949, 0.41421356237309515  # steps that spread evenly over 0..1
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(documents: DataFrame, window: int = WINDOW, end: int = END, paths=None,
           with_ids: bool = False) -> DataFrame:
    """Cut every document into pieces of at most ``window`` ids: ``doc_id,
    start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``.

    A document is its text's ids (NULL text: none) and the id ``end``. The
    CRC-32 is over the ids as little-endian unsigned 32-bit numbers.
    """
    small_batches(documents.sparkSession)
    paths = paths or default_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(*paths)
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = np.append(encode(text or ""), [end]).astype("<u4")
                for s in range(0, len(ids), window):
                    cut = ids[s:s + window]
                    row = (doc, s, len(cut), zlib.crc32(cut.tobytes()), len(ids))
                    out.append((*row, cut.astype(np.int32)) if with_ids else row)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInPandas(run, PIECES + (", ids array<int>" if with_ids else ""))


def combinations(have: np.ndarray, window: int = WINDOW, step: int = 32) -> np.ndarray:
    """Combinations of one, two and three lengths that fill ``window`` exactly and
    whose lengths all occur: rows of three lengths, 0 where there is none.
    The smallest of three is a multiple of ``window / step``, which keeps
    their number linear in ``window``."""
    there = np.zeros(window + 1, bool)
    there[have] = True
    out = [np.array([[window, 0, 0]])] if there[window] else []
    a = np.arange(1, window // 2 + 1)
    a = a[there[a] & there[window - a]]
    out.append(np.stack([a, window - a, np.zeros_like(a)], 1))
    unit = max(window // step, 1)
    for first in range(unit, window // 3 + 1, unit):
        if there[first]:
            b = np.arange(first, (window - first) // 2 + 1)
            b = b[there[b] & there[window - first - b]]
            out.append(np.stack([np.full_like(b, first), b, window - first - b], 1))
    return np.concatenate(out)


def deep_combinations(hist: np.ndarray, window: int = WINDOW, many: int = DEEP) -> np.ndarray:
    """At most ``many`` combinations of more lengths that fill ``window`` exactly, spread like the
    histogram: rows padded with 0.

    As many lengths are taken as fill a window on average, or a few fewer or
    more. The first takes every length in turn, the next ones quantiles of the histogram
    along a low-discrepancy sequence, and the last two are a pair that closes
    the window, from a table of the pairs that reach each total. Lengths, not
    rests, are counted here, so the work is bounded whatever the corpus.
    """
    have = np.flatnonzero(hist)
    if not len(have):
        return np.zeros((0, 1), np.int64)
    middle = window / np.average(have, weights=hist[have])
    share = np.cumsum(hist[have]) / hist[have].sum()
    # pairs by total: t is reached by (low[k], t - low[k]) for k in first[t]..first[t + 1] - 1
    x, y = np.triu_indices(len(have))
    total = have[x] + have[y]
    order = np.argsort(total, kind="stable")
    low = have[x[order]]
    first = np.searchsorted(total[order], np.arange(window + 2))
    depths = sorted({max(int(middle) + d, 3) for d in (-2, -1, 0, 1, 2, 3)})
    width, out = depths[-1], []
    for depth in depths:
        n = -(-many // len(depths))
        k = np.arange(n)
        rows = np.zeros((n, width), np.int64)
        rows[:, 0] = have[k % len(have)]
        for j in range(1, depth - 2):
            at = (k * GOLDEN + j * SILVER + depth * 0.13) % 1.0  # every row and place another quantile
            rows[:, j] = have[np.searchsorted(share, at).clip(max=len(have) - 1)]
        rest = window - rows.sum(1)
        fits = rest > 0
        rest = np.where(fits, rest, 0)
        pairs = first[rest + 1] - first[rest]
        fits &= pairs > 0
        pick = low[np.minimum(first[rest] + (k * 7919) % np.maximum(pairs, 1), max(len(low) - 1, 0))]
        rows[:, depth - 2], rows[:, depth - 1] = pick, rest - pick
        out.append(rows[fits])
    return np.unique(-np.sort(-np.concatenate(out), axis=1), axis=0)


def solve(combos: np.ndarray, hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist|^2, where A counts each
    length in each combination; multiplicative updates keep x >= 0."""
    if not len(combos):
        return np.zeros(0)
    flat, used = combos.ravel(), (combos > 0).astype(float)

    def lengths(x):  # A x
        return np.bincount(flat, np.repeat(x, combos.shape[1]) * used.ravel(), len(hist))

    def back(v):  # A' v
        return (v[combos] * used).sum(1)

    want = back(hist.astype(float))
    x = np.maximum(want, 1e-9) / np.maximum(back(lengths(np.ones(len(combos)))), 1e-9)
    for _ in range(rounds):
        x *= want / np.maximum(back(lengths(x)), 1e-12)
    return x


def rounded(x: np.ndarray) -> np.ndarray:
    """Whole numbers near ``x``, largest first, whose sum stays within one of that of ``x``: what is cut off
    one is added to the next."""
    order = np.argsort(-x, kind="stable")
    out = np.zeros(len(x), np.int64)
    out[order] = np.diff(np.floor(np.cumsum(x[order]) + 1e-9), prepend=0).astype(np.int64)
    return out


def use(combos: np.ndarray, counts: np.ndarray, left: np.ndarray) -> list[tuple[list[int], int]]:
    """Combinations with how often they are used, no more than their lengths last; ``left`` is lessened."""
    patterns = []
    for c in np.argsort(-counts, kind="stable"):
        if counts[c] <= 0:
            break
        lengths = [int(x) for x in combos[c] if x]
        n = min(int(counts[c]), *(int(left[x]) // lengths.count(x) for x in set(lengths)))
        if n > 0:
            patterns.append((lengths, n))
            for x in lengths:
                left[x] -= n
    return patterns


@dataclass
class Plan:
    """Places by length: occurrences ``first .. first + repeat - 1`` of ``length`` go to sequences
    ``sequence, sequence + 1, ...`` at ``offset``; sorted by (length, first)."""
    key: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    solved: int  # the first so many sequences follow from the least squares

    def place(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) | k, "right") - 1
        return self.sequence[at] + k - self.first[at], self.offset[at]


def plan(hist: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan for ``hist[length]`` rests, lengths 1..window; every rest gets a place."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(np.flatnonzero(left), window)
    patterns = use(combos, rounded(solve(combos, left)), left)
    for _ in range(DEEP_ROUNDS):  # rests too short for shallow combinations: deeper ones, on what is left
        before = int((left * np.arange(window + 1)).sum())
        if before < DEEP_LEAST * int((hist[1:] * np.arange(1, window + 1)).sum()) or before < window:
            break
        combos = deep_combinations(left, window)
        patterns += use(combos, rounded(solve(combos, left, 100)), left)
        if int((left * np.arange(window + 1)).sum()) > 0.9 * before:
            break
    solved = sum(n for _, n in patterns)
    # the residual: the longest left, then always the longest that still fits;
    # such a sequence is repeated as long as all its lengths last
    rest = {int(x): int(left[x]) for x in np.flatnonzero(left)}
    there = sum(1 << x for x in rest)
    while there:
        gap, lengths, taken = window, [], {}
        mask = there
        while True:
            x = (mask & ((1 << (gap + 1)) - 1)).bit_length() - 1
            if x <= 0:
                break
            lengths.append(x)
            taken[x] = taken.get(x, 0) + 1
            gap -= x
            if taken[x] == rest[x]:
                mask &= ~(1 << x)
        n = min(rest[x] // m for x, m in taken.items())
        patterns.append((lengths, n))
        for x, m in taken.items():
            rest[x] -= n * m
            if not rest[x]:
                there &= ~(1 << x)
    rows, used, sequence = [], {}, 0
    for lengths, n in patterns:
        offset = 0
        for x in lengths:
            rows.append((x, used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan((table[:, 0] << 48) | table[:, 1], table[:, 1], table[:, 2], table[:, 3], sequence, solved)


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, start, length,
    ids_crc32`` and whatever else they carry).

    Offsets of a sequence have no gaps. Only the histogram -- at most
    ``window`` counts -- reaches the driver. Pieces of one length, however
    many, are numbered in 1024 groups side by side. No pieces: no rows.
    """
    spark = cut.sparkSession
    small_batches(spark)
    cut = staged(cut.withColumn("_sub", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(1024))),
                 "pack-pieces")
    hist = np.zeros(window + 1, np.int64)
    for r in cut.groupBy("length").count().collect():
        hist[r["length"]] = r["count"]
    shared = spark.sparkContext.broadcast(plan(hist, window))
    rows = numbered(cut, ["length"], "_sub", [F.col(c) for c in ("doc_id", "start", "ids_crc32")], "_k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b["sequence_id"], b["offset"] = shared.value.place(b["length"].to_numpy(np.int64),
                                                                   b["_k"].to_numpy(np.int64))
                yield b.drop(columns=["_k", "_sub"])

    kept = [f for f in rows.schema.fields if f.name not in ("_k", "_sub")]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return rows.mapInPandas(run, schema)


def packed(documents: DataFrame, window: int = WINDOW, paths=None) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of
    every piece. NULL and empty texts are one piece of the end id."""
    return pack(pieces(documents, window, paths=paths), window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(documents: DataFrame, window: int = WINDOW, paths=None, pad: int = 0) -> DataFrame:
    """The training sequences themselves: ``sequence_id, ids``, padded with
    ``pad`` to ``window`` unless the length is a power of two. A group is
    one sequence of at most ``window`` ids."""
    rows = pack(pieces(documents, window, paths=paths, with_ids=True), window)
    joined = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    n = F.size("ids")
    padded = F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - n))
    return (joined.select("sequence_id", ids.alias("ids"))
            .withColumn("ids", F.when(n.bitwiseAND(n - 1) == 0, F.col("ids")).otherwise(padded)))
