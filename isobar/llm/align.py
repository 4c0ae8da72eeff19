"""Alignment of two tokenizers by diagonal run skipping (operator 13).

Both tokenizations of a text are arrays of byte ends. Places where both end
cut the tokens into groups. At a common place the two indices differ by some
shift, and most groups are one token to one token, which keeps the shift. So
the arrays are compared along the current shift, a few tokens and then
stretches of 8, 16, 32, ... at a time; where a stretch fails, halving finds its
last common end. The irregular group behind it is walked token by token, the side
that ends first going on, until the ends meet again; that is the new shift.

Tokens that end together are such that the bytes of one are a suffix of the
other's, so all pairs that can ever be linked follow from the vocabularies:
:func:`link_table` lists them, some hundred thousand. Counts over the corpus
are kept by place in that table, which bounds what is sent about.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import small_batches, staged

NEAR = 8  # tokens compared one by one before stretches are
PART = 1 << 20  # characters of the texts aligned at a time, about
SPACE_MARK = "▁"  # fixed value: how the piece vocabulary writes a space


def default_paths() -> tuple[str, str]:
    """Vocabulary A (ranks of a byte-level BPE) and B (a sentencepiece model)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ alignment

def runs(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int]]:
    """Common ends of two rising sequences as ``(i, j, n)``: ``a[i + x]`` equals ``b[j + x]`` for
    ``x`` below ``n``. After the first of a run all its groups are one token to one
    token. Both sequences must end alike."""
    out, i, j, na, nb = [], 0, 0, len(a), len(b)
    while i < na and j < nb:
        x, y = i, j
        near = min(i + NEAR, na, i + nb - j)
        while i < near and a[i] == b[j]:
            i += 1
            j += 1
        if i - x == NEAR:  # a long stretch: compare ever more at a time
            step = NEAR
            while True:  # all up to i and j is equal
                step = min(step, na - i, nb - j)
                if not step or a[i:i + step] != b[j:j + step]:
                    break
                i, j, step = i + step, j + step, step * 2
            while step > 1:  # a stretch of ``step`` fails: halve it
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
        if i > x:
            out.append((x, y, i - x))
        if i < na and j < nb:
            p, q = a[i], b[j]
            if p != q:
                while p != q:
                    if p < q:
                        i += 1
                        p = a[i]
                    else:
                        j += 1
                        q = b[j]
                out.append((i, j, 1))
                i += 1
                j += 1
    return out


# ----------------------------------------------------------------- vocabularies

@dataclass
class Vocabularies:
    """Two encoders, the bytes of their tokens, and the pairs that can be linked:
    ``keys`` is the sorted ``a * len(bytes_b) + b``."""
    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    keys: np.ndarray

    def __post_init__(self):
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # decimal digits of every id, left aligned, zeros behind
        most = max(len(self.bytes_a), len(self.bytes_b))
        width = len(str(most))
        self.digits = np.array([str(i) for i in range(most)], f"S{width}").view(np.uint8).reshape(-1, width)


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE_MARK, " ").encode()


def link_table(bytes_a: list[bytes], bytes_b: list[bytes]) -> np.ndarray:
    """Every pair of which one token's bytes end with the other's, as sorted keys."""
    found = set()
    for swap, long, short in ((False, bytes_a, bytes_b), (True, bytes_b, bytes_a)):
        ids: dict[bytes, list[int]] = {}
        for i, x in enumerate(short):
            ids.setdefault(x, []).append(i)
        for i, x in enumerate(long):
            for cut in range(len(x)):
                for k in ids.get(x[cut:], ()):
                    found.add((k, i) if swap else (i, k))
    return np.array(sorted(a * len(bytes_b) + b for a, b in found), np.int64)


@lru_cache(maxsize=1)
def vocabularies(ranks_path: str, model_path: str) -> Vocabularies:
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(x): int(r) for x, r in map(bytes.split, f)}
    a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=model_path)
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for x, r in ranks.items():
        bytes_a[r] = x
    bytes_b = [b"" if b.is_control(i) or b.is_unknown(i) else piece_bytes(b.id_to_piece(i))
               for i in range(b.get_piece_size())]
    return Vocabularies(a.encode_ordinary, lambda t: b.encode(t, num_threads=1), bytes_a, bytes_b,
                        link_table(bytes_a, bytes_b))


def tokens(v: Vocabularies, text: str | None) -> tuple[Sequence[int], Sequence[int]]:
    """Ids of both vocabularies for a space and the text; none if the text is NULL or empty or either
    side's bytes do not give it back."""
    if text:
        whole = b" " + text.encode("utf-8", "surrogatepass")
        a, b = v.encode_a(" " + text), v.encode_b(text)
        if b"".join([v.bytes_b[i] for i in b]) == whole and b"".join([v.bytes_a[i] for i in a]) == whole:
            return a, b
    return (), ()


@dataclass
class Aligned:
    """Texts one after the other: ids of both sides, tokens of each text, the last token of every
    group on both sides, and groups of each text."""
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    groups: np.ndarray

    @staticmethod
    def of(v: Vocabularies, texts: list[str | None]) -> Aligned:
        """All texts are aligned in one walk: where a text ends, both sides end."""
        pairs = [tokens(v, t) for t in texts]
        n_a, n_b = (np.array([len(x[k]) for x in pairs], np.int64) for k in (0, 1))
        a, b = (np.concatenate([np.asarray(x[k], np.int64) for x in pairs] or [np.zeros(0, np.int64)])
                for k in (0, 1))
        found = runs(np.cumsum(v.size_a[a]).tolist(), np.cumsum(v.size_b[b]).tolist())
        i, j, n = np.array(found, np.int64).reshape(-1, 3).T
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        last_a, last_b = np.repeat(i, n) + inside, np.repeat(j, n) + inside
        return Aligned(a, b, n_a, n_b, last_a, last_b,
                       np.diff(np.searchsorted(last_a, np.cumsum(n_a)), prepend=0))

    def spelt(self, v: Vocabularies) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text, decimal ids of its groups; empty without tokens."""
        size_a, size_b = (np.diff(x + 1, prepend=0) for x in (self.last_a, self.last_b))
        mark = np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        # where a side's tokens stand when each group's A tokens are followed by its B tokens
        before = np.cumsum(size_b) - size_b
        at_a = np.arange(len(self.a)) + np.repeat(before, size_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.last_a + 1, size_b)
        ids = np.empty(len(mark), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[self.last_a]] = ord("|")
        mark[at_b[self.last_b]] = ord(";")
        rows = np.concatenate([v.digits[ids], mark[:, None]], axis=1)
        text = rows.ravel()
        text = text[text != 0].tobytes()
        ends = np.cumsum((rows != 0).sum(1))
        ends = np.r_[0, ends][np.cumsum(self.n_a + self.n_b)]
        return [text[lo:max(hi - 1, lo)] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]


# ------------------------------------------------------------------------ jobs

def aligned(documents: DataFrame, paths=None, with_tokens: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, groups_sha256, links`` of every document, and, if asked
    for, ``a, b, last_a, last_b``: both id lists and the place of each group's last token
    in them. ``links`` are places in :func:`link_table`, one for each group."""
    small_batches(documents.sparkSession)
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*paths)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            # texts of about PART characters together; a longer one alone
            part = np.cumsum([len(t or "") for t in texts]) // PART
            for lo, hi in spans(part):
                yield _row_batch(v, batch.column("doc_id").slice(lo, hi - lo), texts[lo:hi], with_tokens)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    more = ", a array<int>, b array<int>, last_a array<int>, last_b array<int>" if with_tokens else ""
    return rows.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, groups_sha256 string, links array<int>" + more)


def spans(part: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stretches of equal numbers."""
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return [x for x in zip(cuts, cuts[1:]) if x[0] < x[1]]


def _row_batch(v: Vocabularies, doc_id: pa.Array, texts: list[str | None], with_tokens: bool) -> pa.RecordBatch:
    x = Aligned.of(v, texts)
    links = np.searchsorted(v.keys, x.a[x.last_a] * len(v.bytes_b) + x.b[x.last_b])

    def lists(values: np.ndarray, size: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(values, pa.int32()))

    cols = {"doc_id": doc_id, "n_a": pa.array(x.n_a), "n_b": pa.array(x.n_b),
            "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in x.spelt(v)], pa.string()),
            "links": lists(links, x.groups)}
    if with_tokens:
        first_a, first_b = (np.repeat(np.cumsum(n) - n, x.groups) for n in (x.n_a, x.n_b))
        cols |= {"a": lists(x.a, x.n_a), "b": lists(x.b, x.n_b), "last_a": lists(x.last_a - first_a, x.groups),
                 "last_b": lists(x.last_b - first_b, x.groups)}
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def link_counts(rows: DataFrame) -> DataFrame:
    """``link, n``: how often each pair is linked in ``rows`` (:func:`aligned`). A task adds
    up its rows before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            some = np.bincount(b.column("links").flatten().to_numpy(zero_copy_only=False))
            if len(some) > len(total):
                total, some = some, total
            total[:len(some)] += some
        link = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(link, pa.int64()), pa.array(total[link], pa.int64())],
                                         ["link", "n"])

    return (rows.select("links").mapInArrow(run, "link bigint, n bigint")
            .groupBy("link").agg(F.sum("n").alias("n")))


def lexicon(rows: DataFrame, paths=None) -> DataFrame:
    """``a, b, n, best``: every linked pair of ids with its count; ``best`` if no pair of the same
    B id has a higher one."""
    v = vocabularies(*(paths or default_paths()))
    counts = link_counts(rows).toArrow()  # at most len(v.keys) rows
    link, n = counts.column("link").to_numpy(), counts.column("n").to_numpy()
    a, b = np.divmod(v.keys[link], len(v.bytes_b))
    top = np.zeros(len(v.bytes_b), np.int64)
    np.maximum.at(top, b, n)
    table = pa.table({"a": a, "b": b, "n": n, "best": n == top[b]})
    return rows.sparkSession.createDataFrame(table)


def report(documents: DataFrame, paths=None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    Tokens end together once a group, at its end, so there are as many links
    as groups. A link's count is how many links of all documents have its
    ids; ``n_best`` counts links whose count no other pair of their B id
    exceeds. Texts that are NULL, empty or not given back by both
    tokenizers have zeros and ''. Repeated rows count one by one; other columns are
    ignored; no rows give none.
    """
    spark = documents.sparkSession
    small_batches(spark)
    paths = paths or default_paths()
    rows = staged(aligned(documents, paths), "align-links")
    counts = link_counts(rows).toArrow()  # bounded by the vocabularies, see link_table
    v = vocabularies(*paths)
    n = np.zeros(len(v.keys), np.int64)
    n[counts.column("link").to_numpy()] = counts.column("n").to_numpy()
    b = v.keys % len(v.bytes_b)
    top = np.zeros(len(v.bytes_b), np.int64)
    np.maximum.at(top, b, n)
    shared = spark.sparkContext.broadcast((n, n == top[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            links = batch.column("links")
            size = links.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = links.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)

            def total(x: np.ndarray) -> np.ndarray:
                s = np.r_[0, np.cumsum(x, dtype=np.int64)]
                return s[ends] - s[ends - size]

            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_a"), batch.column("n_b"), pa.array(size), pa.array(size),
                 pa.array(total(best[at])), pa.array(total(count[at])), batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                "n_best bigint, count_sum bigint, groups_sha256 string")
