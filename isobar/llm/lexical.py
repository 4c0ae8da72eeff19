"""Ranked lexical search over geometrically blocked postings (operator 12).

Documents are dealt into segments; each segment is indexed and searched by one
task, so no posting list, however common its term, is ever in one place.
Within a segment every posting list is clustered: documents are vectors of
term impacts, a few of the list's documents are representatives, and each
document joins the representative it is most similar to. Clusters are cut
into blocks, and a block's summary is the coordinatewise maximum of its
vectors. So ``query . summary`` is at least the score of every document in
the block.

A query goes through its terms' lists, the one with the largest possible
contribution first, and skips a block only if that bound is below the score
of its k-th best document so far. It stops when all terms left together
cannot reach that score. Both tests are exact in whole numbers, so the result
is the same as scoring every document. The k best are carried from segment to
segment of a task; tasks send k rows a query, which are merged.

Only terms of the queries are kept of a document. Queries are sent to the tasks in
blocks of bounded size; a benchmark of any size is so many blocks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import small_batches, staged

# Fixed value: after A-Z became a-z, a term is a run of digits, letters and characters beyond ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
K = 20
QUERY_BYTES = 8 << 20  # of the item texts of one block of queries, about
SEGMENT_DOCS = 16384  # documents of a segment, and entries of its vectors, at most
SEGMENT_ENTRIES = 2 << 20
BLOCK = 48  # documents of a posting block, at most
SKETCH = 48  # coordinates of the vectors that are compared when a list is clustered
FAR = np.iinfo(np.int64).max


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text; bytes.lower changes A-Z alone."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Queries:
    """A block of queries: rows ``(item_id, text)``, the vocabulary, and for each row its
    (term, occurrences)."""
    rows: list[tuple]
    vocabulary: dict[bytes, int]
    counts: list[list[tuple[int, int]]]

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        counts = [[(vocabulary.setdefault(t, len(vocabulary)), c) for t, c in Counter(terms(text)).items()]
                  for _, text in rows]
        return Queries(rows, vocabulary, counts)


def vectors(documents: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id, n, terms, tf``: terms of the whole text with repeats, and the
    query terms among them with their occurrences."""
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(queries.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            n, which, often = [], [], []
            for text in b.column("text"):
                found = terms(text.as_py())
                n.append(len(found))
                mine = [(known[t], c) for t, c in Counter(found).items() if t in known]
                which.append([t for t, _ in mine])
                often.append([c for _, c in mine])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(which, pa.list_(pa.int32())),
                 pa.array(often, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def weights(stored: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weight of each term of the vocabulary. One count a term comes to the driver."""
    df = np.zeros(size, np.int64)
    counts = stored.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df[counts.column("t").to_numpy()] = counts.column("count").to_numpy()
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of ``lo[i] .. lo[i] + size[i] - 1``, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(lo - (ends - size), size)


def sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of each of the groups of ``size`` values that follow one another."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(size)
    return total[ends] - total[ends - size]


@dataclass
class Blocks:
    """The blocks of one posting list: documents of block ``b`` are ``docs[first[b]:first[b + 1]]``; the
    summaries' terms and maxima follow one another, ``width[b]`` of each."""
    docs: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    most: np.ndarray
    width: np.ndarray


@dataclass
class Segment:
    """Documents' impact vectors in rows, their postings, and the blocks made so far."""
    ids: np.ndarray
    null: np.ndarray
    at: np.ndarray
    terms: np.ndarray
    impact: np.ndarray
    weight: np.ndarray
    blocks: dict[int, Blocks] = field(default_factory=dict)

    def __post_init__(self):
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.at))
        order = np.argsort(self.terms, kind="stable")
        self.postings = owner[order]
        self.lists = np.searchsorted(self.terms[order], np.arange(len(self.weight) + 1))
        self.top = np.zeros(len(self.weight), np.int64)  # the largest impact in each list
        np.maximum.at(self.top, self.terms, self.impact)
        # similarity of documents: their weighted vectors, terms folded into few signed coordinates
        spread = np.arange(len(self.weight), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        axis = ((spread >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64)
        sign = 1.0 - 2.0 * ((spread >> np.uint64(39)) & np.uint64(1)).astype(float)
        flat = np.bincount(owner * SKETCH + axis[self.terms], sign[self.terms] * self.impact * self.weight[self.terms],
                           len(self.ids) * SKETCH)
        self.sketch = flat.reshape(-1, SKETCH).astype(np.float32)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents' vector entries, and how many each has."""
        size = self.at[docs + 1] - self.at[docs]
        return ranges(self.at[docs], size), size

    def score(self, docs: np.ndarray, query: np.ndarray) -> np.ndarray:
        at, size = self.entries(docs)
        return sums(query[self.terms[at]] * self.impact[at], size)

    def blocked(self, term: int) -> Blocks:
        """The clustered blocks of a term's list, made when a query first needs them."""
        if term not in self.blocks:
            docs = self.postings[self.lists[term]:self.lists[term + 1]]
            many = -(-len(docs) // BLOCK)
            cluster = np.zeros(len(docs), np.int64)
            if many > 1:
                near = self.sketch[docs] @ self.sketch[docs[::len(docs) // many]].T
                cluster = near.argmax(1)
            order = np.argsort(cluster, kind="stable")
            docs, cluster = docs[order], cluster[order]
            place = np.arange(len(docs)) - np.searchsorted(cluster, cluster)
            first = np.flatnonzero((np.r_[-1, cluster[:-1]] != cluster) | (place % BLOCK == 0))
            first = np.r_[first, len(docs)]
            at, size = self.entries(docs)
            block = np.repeat(np.repeat(np.arange(len(first) - 1), np.diff(first)), size)
            key = block * len(self.weight) + self.terms[at]
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            self.blocks[term] = Blocks(docs, first, key[new] % len(self.weight),
                                       np.maximum.reduceat(self.impact[at][order], new),
                                       np.bincount(key[new] // len(self.weight), minlength=len(first) - 1))
        return self.blocks[term]


@dataclass
class Best:
    """The k best documents of a query so far, best first: higher score, then smaller id, NULL last."""
    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """The score that a document must reach (it may win a tie); at least 1."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            score, null, ids = (np.r_[a, b[good]] for a, b in (
                (self.score, score), (self.null, null), (self.ids, ids)))
            order = np.lexsort((ids, null, -score))[:self.k]
            self.score, self.null, self.ids = score[order], null[order], ids[order]


def search_segment(segment: Segment, counts: list[list[tuple[int, int]]], best: list[Best]) -> int:
    """Let every query see the segment; returns how many documents were scored."""
    query, scored = np.zeros(len(segment.weight), np.int64), 0
    for own, top in zip(counts, best):
        lists = [(c * int(segment.weight[t]) * int(segment.top[t]), t, c) for t, c in own]
        lists = sorted((x for x in lists if x[0] > 0), reverse=True)
        left = sum(x[0] for x in lists)
        used = np.array([t for _, t, _ in lists], np.int64)
        query[used] = [c * int(segment.weight[t]) for _, t, c in lists]
        seen = np.zeros(len(segment.ids), bool)
        for most, t, _ in lists:
            if left < top.least:  # documents not seen yet hold only these terms
                break
            left -= most
            b = segment.blocked(t)
            bound = sums(query[b.terms] * b.most, b.width)
            order = np.argsort(-bound, kind="stable")
            done = 0
            while done < len(order) and bound[order[done]] >= top.least:
                some = order[done:done + max(done, 2)]  # twice as many each time
                done += len(some)
                some = some[bound[some] >= top.least]
                docs = b.docs[ranges(b.first[some], b.first[some + 1] - b.first[some])]
                docs = docs[~seen[docs]]
                if len(docs):
                    seen[docs] = True
                    scored += len(docs)
                    top.offer(segment.score(docs, query), segment.null[docs], segment.ids[docs])
        query[used] = 0
    return scored


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count is worth, before the term's weight."""
    m = 100 - 25 + (25 * n * n_docs) // max(n_terms, 1)
    return (1000000000 * tf) // (1000 * tf + 12 * m)


def segments(batches: Iterator[pa.RecordBatch], weight: np.ndarray, n_docs: int, n_terms: int) -> Iterator[Segment]:
    held: list[pa.RecordBatch] = []

    def made() -> Segment:
        t = pa.Table.from_batches(held)
        ids, lists = t.column("doc_id"), t.column("terms")
        size = lists.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        term = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = t.column("tf").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        n = np.repeat(t.column("n").to_numpy(), size)
        live = weight[term] > 0  # other terms add nothing
        size = sums(live.astype(np.int64), size)
        return Segment(ids.fill_null(FAR).to_numpy(), ids.is_null().to_numpy(), np.r_[0, np.cumsum(size)],
                       term[live], impacts(tf[live], n[live], n_docs, n_terms), weight)

    docs = entries = 0
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            more = len(part.column("terms").flatten())
            if held and (docs + part.num_rows > SEGMENT_DOCS or entries + more > SEGMENT_ENTRIES):
                yield made()
                held, docs, entries = [], 0, 0
            held.append(part)
            docs, entries = docs + part.num_rows, entries + more
    if held:
        yield made()


def search_block(documents: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``query, doc_id, score``: each task's k best documents of every query of the block."""
    spark = documents.sparkSession
    stored = staged(vectors(documents, queries), "search-vectors")
    row = stored.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = row.docs, row.terms or 0
    weight = weights(stored, n_docs, len(queries.vocabulary))
    shared = spark.sparkContext.broadcast((queries.counts, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, w = shared.value
        best = [Best(k) for _ in counts]
        for segment in segments(batches, w, n_docs, n_terms):
            search_segment(segment, counts, best)
        for lo in range(0, len(best), 1000):
            some = best[lo:lo + 1000]
            ids, null = np.concatenate([x.ids for x in some]), np.concatenate([x.null for x in some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(lo, lo + len(some)), [len(x.ids) for x in some])),
                 pa.array(ids, pa.int64(), mask=null), pa.array(np.concatenate([x.score for x in some]))],
                ["query", "doc_id", "score"])

    return stored.filter(F.size("terms") > 0).mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def search(documents: DataFrame, items: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0,
    equal scores by smaller doc_id, NULL last.

    Repeated rows of ``items`` ask once; an item_id with several texts asks
    with each, and has ranks for each. NULL and term-less items find nothing,
    such documents are never found; repeated documents are ranked one by one. Other
    columns are ignored. Empty tables give no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    asked = staged(items.select("item_id", "text").filter("text is not null").distinct(), "search-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // query_bytes)
    found = None
    for part in range(parts):  # one unless the items exceed ``query_bytes``
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        q = Queries.of([(r.item_id, r.text) for r in mine.orderBy("item_id", "text").collect()])
        if not q.vocabulary:
            continue
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(q.rows)], f"query bigint, item_id "
                                      f"{dict(asked.dtypes)['item_id']}")
        hits = staged(search_block(documents, q, k), "search-hits")
        w = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        best = best.join(names, "query").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.union(best)
    if found is None:
        found = spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id bigint, "
                                          "score bigint")
    return found
