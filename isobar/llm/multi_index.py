"""Approximate nearest neighbours with an inverted multi-index (operator 10).

Vectors are cut into two halves, each half has its own codebook, and a cell is
a pair of centroids. A query visits cells in order of the summed scores of
its halves, taken from a heap, until the cells visited hold enough entries,
and all their entries are reranked exactly. How many entries are enough is
measured: a few queries are answered by brute force over all vectors, and
the depth is set so that the wanted share of their neighbours is reached. A
query never stops before it has seen as many other entries as it must return.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import hash_sample, small_batches, staged

# Codebooks are fitted on at most FIT_ROWS vectors (smallest id hashes); a half has from
# CENTROIDS to MOST_CENTROIDS entries, growing with the table; the depth is measured with PROBES
# of those vectors.
FIT_ROWS = 20000
CENTROIDS = 64
MOST_CENTROIDS = 512
PROBES = 200
RECALL = 0.95
BLOCK = 16384  # most vectors, and about as many queries, that meet in one task


def usable(embedding: str = "embedding") -> Column:
    """Vectors that take part: not NULL or empty, no NULL or non-finite
    component, not all zero."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def vectors(embeddings: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(id, v)`` of the vectors that take part, ``v`` as packed doubles. Only the
    most frequent length (the smaller of ties) can be compared; others and
    rows without an id take no part."""
    small_batches(embeddings.sparkSession)
    ok = embeddings.filter(usable(embedding) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    top = (ok.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "d").limit(1).collect())
    if not top:
        return ok.filter("false").select("id", F.lit(b"").alias("v"))
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["v"] = [np.asarray(x, "<f8").tobytes() for x in b["v"]]
            yield b

    return ok.filter(F.size("v") == top[0].d).mapInPandas(pack, "id bigint, v binary")


def matrix(column) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    column = list(column)
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1) if column else np.zeros((0, 1))


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def nearest_centroid(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centroids.T - 0.5 * (centroids * centroids).sum(1), 1)


def book_size(n: int) -> int:
    """Centroids of a half for ``n`` vectors: cells are their square, so entries of a cell
    stay at about 256 until the codebook is at its largest."""
    return min(MOST_CENTROIDS, max(CENTROIDS, math.isqrt(n) // 16))


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means centroids; an empty cluster keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        a = nearest_centroid(x, c)
        n = np.bincount(a, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, a, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray  # entries of each cell (first centroid, second centroid)
    depth: int  # entries a query visits at least

    def blocks(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells laid out in blocks of at most ``size`` entries: the first block of each cell and how
        many it has (more than one where a cell alone is larger). A block is a run of cells with
        one first centroid, and the second ones in the order of their main direction, so that a
        query, which visits similar cells, meets few blocks."""
        first, parts = np.zeros(self.counts.shape, np.int64), np.ones(self.counts.shape, np.int64)
        second = self.books[1] - self.books[1].mean(0)
        order = np.argsort(second @ np.linalg.svd(second, full_matrices=False)[2][0], kind="stable") \
            if second.size else np.arange(len(second))
        block = -1
        for c1 in range(len(self.counts)):
            held = size  # a centroid's first cell begins a block
            for c2 in order:
                n = int(self.counts[c1, c2])
                if n and held + n > size:
                    block, held = block + 1, 0
                first[c1, c2] = max(block, 0)
                if n > size:
                    parts[c1, c2] = -(-n // size)
                    block += int(parts[c1, c2]) - 1
                    n = size  # nothing more goes into its blocks
                held += n
        return first, parts

    def visit(self, query: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Non-empty cells in order of summed score, best first, each with the
        number of entries visited before it. The heap holds the frontier of pairs
        of ranked centroids; a pair enters once both its better neighbours
        have been taken."""
        first, second = (b @ h[0] for b, h in zip(self.books, halves(query[None, :])))
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        s, t = first[a].tolist(), second[b].tolist()
        a, b = a.tolist(), b.tolist()
        reach = [0] * len(a)  # pairs taken in each row
        heap, seen = [(-(s[0] + t[0]), 0, 0)], 0
        while heap:
            _, i, j = heapq.heappop(heap)
            n = int(self.counts[a[i], b[j]])
            if n:
                yield a[i], b[j], seen
                seen += n
            reach[i] = j + 1
            if i + 1 < len(a) and reach[i + 1] == j:
                heapq.heappush(heap, (-(s[i + 1] + t[j]), i + 1, j))
            if j + 1 < len(b) and (i == 0 or reach[i - 1] > j + 1):
                heapq.heappush(heap, (-(s[i] + t[j + 1]), i, j + 1))


def top(scores: np.ndarray, ids: np.ndarray, q: np.ndarray, x: np.ndarray, k: int):
    """Columns of the exact best ``k`` of each row and their scores: larger score first, ties to
    the smaller id; entries of -inf are left out. Scores returned are dot products
    of one pair at a time, so equal vectors score exactly the same."""
    n = scores.shape[1]
    for row in range(len(scores)):
        s = scores[row]
        if n > k:
            edge = np.partition(s, n - k)[n - k]
            near = np.flatnonzero(s >= edge - 1e-9 * (1 + abs(edge)) if np.isfinite(edge) else s > -np.inf)
        else:
            near = np.flatnonzero(s > -np.inf)
        exact = (x[near] * q[row]).sum(1)
        best = np.lexsort((ids[near], -exact))[:k]
        yield near[best], exact[best]


def build(rows: DataFrame, k: int = 20, recall: float = RECALL, centroids: int | None = None) -> tuple:
    """Fit codebooks of ``centroids`` entries (``book_size`` of the table if None; fewer if
    the fitting sample is small), index every distinct row of ``rows (id, v)`` and measure
    the depth. Returns the index and the entries ``(id, v, c1, c2)``; (None, entries) for an empty table."""
    spark = rows.sparkSession
    small_batches(spark)
    rows = staged(rows.distinct(), "ann-vectors")
    fit = hash_sample(rows, FIT_ROWS, "id", "v").collect()
    if not fit:
        return None, rows.withColumn("c1", F.lit(0)).withColumn("c2", F.lit(0))
    x = matrix(r.v for r in fit)
    size = max(1, min(centroids or book_size(rows.count()), len(x) // 16))
    books = tuple(codebook(h, size) if h.shape[1] else np.zeros((1, 0)) for h in halves(x))
    shared = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b["c1"], b["c2"] = (nearest_centroid(h, c).astype(np.int32)
                                    for h, c in zip(halves(matrix(b["v"])), shared.value))
                yield b

    entries = staged(rows.mapInPandas(assign, "id bigint, v binary, c1 int, c2 int"), "ann-entries")
    counts = np.zeros([len(b) for b in books], np.int64)
    for r in entries.groupBy("c1", "c2").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        counts[r.c1, r.c2] = r["count"]
    index = Index(books, counts, 0)
    ids, probes = np.array([r.id for r in fit[:PROBES]]), x[:PROBES]
    asked = spark.sparkContext.broadcast((ids, probes))

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, probes = asked.value
        best: list[np.ndarray | None] = [None] * len(ids)  # of the task's batches: -score, id, c1, c2
        for b in filter(len, batches):
            y, own, c1, c2 = matrix(b["v"]), b["id"].to_numpy(), b["c1"].to_numpy(), b["c2"].to_numpy()
            s = probes @ y.T
            s[ids[:, None] == own[None, :]] = -np.inf
            for p, (at, score) in enumerate(top(s, own, probes, y, k)):
                rows = np.rec.fromarrays([-score, own[at], c1[at], c2[at]], names="far,id,c1,c2")
                both = rows if best[p] is None else np.concatenate([best[p], rows])
                best[p] = both[np.lexsort((both["id"], both["far"]))[:k]]
        for p, rows in enumerate(best):
            if rows is not None:
                yield pd.DataFrame({"probe": p, "id": rows["id"], "score": -rows["far"], "c1": rows["c1"], "c2": rows["c2"]})

    w = Window.partitionBy("probe").orderBy(F.desc("score"), "id")
    true = (entries.mapInPandas(brute, "probe int, id bigint, score double, c1 int, c2 int")
            .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).collect())  # PROBES * k rows
    depths = []
    for p in range(len(probes)):
        want = {(r.c1, r.c2) for r in true if r.probe == p}
        before = {}
        for c1, c2, seen in index.visit(probes[p]):
            if (c1, c2) in want:
                before[c1, c2] = seen + 1
                if len(before) == len(want):
                    break
        depths += [before[r.c1, r.c2] for r in true if r.probe == p]
    index.depth = int(np.ceil(np.quantile(depths, recall))) if depths else 1
    return index, entries


def search(index: Index | None, entries: DataFrame, is_query: Column, k: int = 20, size: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each entry with
    ``is_query``, among all other entries, by largest inner product.

    Queries go to the blocks that hold cells they visit, and entries lie in one block each, so an
    entry is shuffled once. Only a block that more than ``size`` queries visit is copied, once
    for each ``size`` (``BLOCK`` if None) of them, so a task holds about ``size`` of either. A query takes cells until
    they hold the index's depth, and at least ``k``, besides all entries of its own
    id, so fewer than ``k`` are found only where there are fewer.

    Entries are distinct pairs of id and vector, so a repeated row asks once and is
    found once. Different vectors under one id are entries of their own: each asks
    and gets its own list of ranks 1 to ``k`` under the same ``query_id``, each can be
    found, and none is a candidate of a query with that id.
    """
    spark = entries.sparkSession
    small_batches(spark)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    size = size or BLOCK
    first, parts = index.blocks(size)
    shared = spark.sparkContext.broadcast((index, first, parts))
    queries = entries.filter(is_query).select("id", "v")
    own = queries.groupBy("id").agg(F.count(F.lit(1)).alias("own")).filter("own > 1")
    queries = queries.join(own, "id", "left").select("id", "v", F.coalesce("own", F.lit(1)).alias("own"))
    queries = staged(queries.withColumn("ask", F.monotonically_increasing_id()), "ann-queries")

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, first, parts = shared.value
        for b in batches:
            out = []
            for ask, v, own in zip(b["ask"], b["v"], b["own"]):
                cells: dict[int, np.ndarray] = {}
                for c1, c2, seen in index.visit(np.frombuffer(v, "<f8")):
                    if seen - own >= max(index.depth, k):
                        break
                    for block in range(first[c1, c2], first[c1, c2] + parts[c1, c2]):
                        cells.setdefault(block, np.zeros(len(index.books[1]), np.uint8))[c2] = 1
                out += [(ask, block, np.packbits(m).tobytes()) for block, m in cells.items()]
            yield pd.DataFrame(out, columns=["ask", "block", "seen"])

    # without the vectors, which are joined on where the rows are dealt
    visits = staged(queries.repartition(spark.sparkContext.defaultParallelism * 2, "ask")
                    .mapInPandas(traverse, "ask bigint, block bigint, seen binary"), "ann-visits")
    turns = staged(visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("turns")), "ann-turns")
    asked = (visits.join(turns, "block").withColumn("turn", F.pmod(F.xxhash64("ask"), F.col("turns")).cast("int"))
             .join(queries.select("ask", "id", "v"), "ask").select("ask", "id", "v", "block", "turn", "seen"))
    c1, c2 = np.nonzero(index.counts)  # at most MOST_CENTROIDS ** 2 cells
    cells = spark.createDataFrame(pd.DataFrame({"c1": c1.astype(np.int32), "c2": c2.astype(np.int32),
                                                "first": first[c1, c2], "parts": parts[c1, c2]}),
                                  "c1 int, c2 int, first bigint, parts bigint")
    listed = (entries.join(F.broadcast(cells), ["c1", "c2"])
              .withColumn("block", F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("parts"))).join(turns, "block")
              .select("id", "v", "c2", "block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")))

    def rerank(key, qs: pd.DataFrame, es: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qs) and len(es):
            n2 = len(shared.value[0].books[1])
            x, ids, c2 = matrix(es["v"]), es["id"].to_numpy(), es["c2"].to_numpy()
            step = max(1, (1 << 22) // len(x))  # bounds the block of scores
            for i in range(0, len(qs), step):
                part = qs.iloc[i:i + step]
                q, own, ask = matrix(part["v"]), part["id"].to_numpy(), part["ask"].to_numpy()
                seen = np.unpackbits(np.frombuffer(b"".join(part["seen"]), np.uint8).reshape(len(part), -1),
                                     axis=1)[:, :n2].astype(bool)
                s = q @ x.T
                s[~seen[:, c2]] = -np.inf
                s[own[:, None] == ids[None, :]] = -np.inf
                out += [(ask[r], own[r], ids[at], e) for r, (at, e) in enumerate(top(s, ids, q, x, k)) if len(at)]
        return pd.DataFrame(out, columns=["ask", "query_id", "ids", "scores"])

    near = (asked.groupBy("block", "turn").cogroup(listed.groupBy("block", "turn"))
            .applyInPandas(rerank, "ask bigint, query_id bigint, ids array<bigint>, scores array<double>"))
    flat = near.select("ask", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select(
        "ask", "query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    w = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    return (flat.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest of each distinct vector whose ``vec_id`` is divisible by ``every``."""
    index, entries = build(vectors(embeddings), k, recall)
    return search(index, entries, F.col("id") % every == 0, k)
