"""SimHash near-duplicates by deletion-variant signatures (operator 3).

Fingerprints of 64 bits link when at most three bits differ. Cut into two
halves, such a pair has a half that differs in one bit at most: the pair
agrees on that half as it stands, or on the half with that one bit removed.
So each distinct fingerprint is indexed under 2 x (1 + 32) keys -- each half
whole, and each half with one bit deleted -- and only fingerprints with an
equal key are compared. Links are found per key in sorted runs, and each run
gives a spanning forest of its links, not all pairs.

A half shared by more fingerprints than ``BLOCK`` would make one large run.
Such keys are known beforehand from the counts of whole halves; their
fingerprints are dealt into blocks, and each pair of blocks is a run of its
own, so that no pair is lost and no run outgrows memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import small_batches, staged
from isobar.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
BLOCK = 1024
HALF = 32
RUN_ROWS = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, unsigned.

    A-Z are lower-cased, words are split at ASCII white space, shingles are
    ``shingle`` words joined by a space, repeats included (a shorter text is
    one shingle); a bit is set if it is set in over half the shingles'
    XXH64 (seed 42). No words or NULL: 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(joined[a:b], 42) for a, b in
                  zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(values), 65536):  # bounds the unpacked bits of a very long text
        ones += np.unpackbits(values[i:i + 65536], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, tie, fp)``: fp as a signed bigint, ``tie`` a hash of the text."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "tie": b["tie"], "fp": fp})

    narrow = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                              F.xxhash64("text").alias("tie"), "text")
    return narrow.mapInPandas(run, "doc_id bigint, tie bigint, fp bigint")


def _keys(fps: DataFrame, block: int) -> DataFrame:
    """Index keys ``(key, cell, fp)``. A key is (half, deleted bit, bits); bit
    32 stands for the whole half. ``cell`` names a pair of blocks of a hot key."""
    halves = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))

    def key(side, bit, bits):
        return F.shiftleft((side * 33 + bit).cast("bigint"), 32).bitwiseOR(bits)

    def variants(rows):
        """rows: (side, bits, ...) -> one row for each deletion variant."""
        left = F.when(F.col("bit") == 32, F.col("bits")).otherwise(
            F.col("bits").bitwiseAND(F.expr("~shiftleft(1L, bit)")))
        return (rows.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(32))))
                .withColumn("key", key(F.col("side"), F.col("bit"), left)))

    by_half = fps.select("fp", F.posexplode(halves).alias("side", "bits"))
    hot = by_half.groupBy("side", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block // 2)
    # one more half may share a deletion variant without being hot itself
    hot = staged(variants(hot).groupBy("key")
                 .agg(F.ceil((F.sum("n") + block // 2) / block).cast("int").alias("blocks")), "sim-hot")
    keyed = variants(by_half).select("key", "fp").join(hot, "key", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j:
                        F.least(mine, j) * 65536 + F.greatest(mine, j))
    cells = F.when(F.coalesce(F.col("blocks"), F.lit(1)) == 1, F.array(F.lit(0))).otherwise(pairs)
    return keyed.select("key", F.explode(cells).alias("cell"), "fp")


def _forest(fp: np.ndarray, bit: int, side: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that span the components of one run of distinct fingerprints."""
    if bit < 32:  # equal halves meet under the whole half already
        there = (fp >> np.uint64(bit + (32 if side == 0 else 0))) & np.uint64(1)
        groups = np.flatnonzero(there == 0), np.flatnonzero(there == 1)
    else:
        groups = (np.arange(len(fp)),) * 2
    if not len(groups[0]) or not len(groups[1]):
        return []
    near = np.bitwise_count(fp[groups[0]][:, None] ^ fp[groups[1]][None, :]) <= max_bits
    at = np.full((2, len(fp)), -1)
    at[0, groups[0]] = np.arange(len(groups[0]))
    at[1, groups[1]] = np.arange(len(groups[1]))
    seen, out = np.zeros(len(fp), bool), []
    for s in range(len(fp)):
        todo = [] if seen[s] else [s]
        seen[s] = True
        while todo:
            x = todo.pop()
            reach = np.zeros(len(fp), bool)
            if at[0, x] >= 0:
                reach[groups[1][near[at[0, x]]]] = True
            if at[1, x] >= 0:
                reach[groups[0][near[:, at[1, x]]]] = True
            new = np.flatnonzero(reach & ~seen)
            seen[new] = True
            todo.extend(new.tolist())
            out.extend((int(x), int(n)) for n in new)
    return out


def _links(key: np.ndarray, cell: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links of sorted, whole runs of equal (key, cell)."""
    change = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
    starts = np.concatenate(([0], change))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    f = fp.view(np.uint64)
    a, b = [], []
    two = starts[sizes == 2]
    ok = np.bitwise_count(f[two] ^ f[two + 1]) <= max_bits
    a.append(fp[two[ok]])
    b.append(fp[two[ok] + 1])
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        tag = int(key[s]) >> 32
        pairs = _forest(f[s:s + n], tag % 33, tag // 33, max_bits)
        if pairs:
            at = np.array(pairs) + s
            a.append(fp[at[:, 0]])
            b.append(fp[at[:, 1]])
    return np.concatenate(a), np.concatenate(b)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that span the same
    components as all pairs within ``max_bits`` (three at most, since one of
    two halves must then differ in one bit at most)."""
    if max_bits > 3:
        raise ValueError("two halves with one deleted bit find pairs of up to three differing bits")
    small_batches(fps.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(parts, last):
            k, c, f = (np.concatenate([p[i] for p in parts]) for i in range(3))
            end = len(k)
            if not last:  # the last run may go on in the next batch
                end = int(np.flatnonzero((k != k[-1]) | (c != c[-1])).max(initial=-1)) + 1
            rest = [(k[end:], c[end:], f[end:])]
            return (_links(k[:end], c[:end], f[:end], max_bits) if end else None), rest

        held: list = []
        n = 0
        for x in batches:
            held.append((x["key"].to_numpy(), x["cell"].to_numpy(), x["fp"].to_numpy()))
            n += len(x)
            if n >= RUN_ROWS:
                found, held = flush(held, False)
                n = len(held[0][0])
                if found is not None and len(found[0]):
                    yield pd.DataFrame({"a": found[0], "b": found[1]})
        if n:
            found, _ = flush(held, True)
            if len(found[0]):
                yield pd.DataFrame({"a": found[0], "b": found[1]})

    keys = _keys(fps, block).repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
    return keys.mapInPandas(run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, tie, fp, component_id, rep_tie``.

    Documents link when their fingerprints differ in at most ``max_bits``
    bits; ``component_id`` is the smallest doc_id reachable (NULL if no
    document reached has one). NULL, empty and word-less texts have
    fingerprint 0 and link like any other. Repeated rows are one row each.
    Equal fingerprints are compared once, so copies cost no more than one.
    """
    docs = staged(fingerprints(documents, shingle), "sim-docs")
    # NULL ids last, then by content: the first is the document that stands for its group
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie"))
    fps = staged(docs.groupBy("fp").agg(first.alias("first")), "sim-fps")
    found = staged(links(fps.select("fp"), max_bits, block).distinct(), "sim-links")
    roots = staged(components(found), "sim-roots")
    rooted = staged(fps.join(roots, F.col("fp") == F.col("node"), "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "sim-rooted")
    group = staged(rooted.groupBy("root").agg(F.min("first").alias("group")), "sim-groups")
    classes = staged(rooted.join(group, "root")
                     .select("fp", F.col("group.doc_id").alias("component_id"),
                             F.col("group.tie").alias("rep_tie")), "sim-classes")
    return docs.join(classes, "fp").select("doc_id", "tie", "fp", "component_id", "rep_tie")


def report(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id``."""
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` with one document of each group: the one with the smallest
    doc_id (then text hash). Of repeated rows of that document one stays.

    Rows are told by (doc_id, text hash). Only the ids of documents that go
    are joined back; texts are shuffled only if those ids are too many to
    broadcast by Spark's own size check.
    """
    classes = near_duplicates(documents, shingle, max_bits)
    rows = classes.groupBy("doc_id", "tie", "component_id", "rep_tie").agg(F.count(F.lit(1)).alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tie") == F.col("rep_tie"))
    rows = rows.select(F.col("doc_id").alias("odd_id"), F.col("tie").alias("odd_tie"), stays.alias("stays"), "n")
    odd = staged(rows.filter(~F.col("stays") | (F.col("n") > 1)).drop("n"), "sim-odd")
    # each row is one struct, so its names cannot clash with the others
    docs = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("tie"))
    same = F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("tie") == F.col("odd_tie"))
    once = docs.join(odd, same, "left_anti")
    repeated = docs.join(odd.filter("stays"), same, "left_semi").dropDuplicates(["id", "tie"])
    return once.unionByName(repeated).select("row.*")
