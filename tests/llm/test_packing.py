import zlib
from collections import defaultdict

import numpy as np
import pytest

from isobar.llm import packing
from isobar.llm.tokens import default_paths, encoder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_paths()[0])


def test_ids_are_those_of_the_tokenizer(spark, tokenizer, edge):
    encode = encoder(*default_paths())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += [r.text or "" for r in edge.collect()]
    texts += ["  x  \t\n\n y'll they'RE 1²３ ⅷ ‍👩‍👧 ́a", "\x00\x01", "<|endoftext|><|endoftext|> a", "  ", "\r\n \r\n"]
    for t in texts:
        assert encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def check(rows, documents, tokenizer, window=2048):
    want = sorted(((d.doc_id, [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1])
                   for d in documents), key=str)
    pieces = sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id is not None)
    cut = sorted((d, s, len(ids[s:s + window]), zlib.crc32(np.array(ids[s:s + window], "<u4").tobytes()), len(ids))
                 for d, ids in want if d is not None for s in range(0, len(ids), window))
    assert pieces == cut
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in want)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return by


def test_packed(spark, tokenizer):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.packed(documents).collect()
    by = check(rows, documents.collect(), tokenizer)
    assert sorted(by) == list(range(len(by)))
    total = sum(r.length for r in rows)
    assert len(by) <= total / 2048 * 1.01 + 1
    again = packing.packed(documents.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_edge_cases(edge, empty, tokenizer):
    check(packing.packed(edge).collect(), edge.collect(), tokenizer)
    assert packing.packed(empty).count() == 0


def test_sequences_hold_the_ids(docs, tokenizer):
    got = {r.sequence_id: r.ids for r in packing.sequences(docs, window=512, pad=0).collect()}
    place = packing.packed(docs, window=512).collect()
    ids = {d.doc_id: [*tokenizer.encode(d.text, add_special_tokens=False).ids, 1] for d in docs.collect()}
    used = defaultdict(int)
    for r in place:
        assert got[r.sequence_id][r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]
        used[r.sequence_id] += r.length
    for s, x in got.items():
        n = used[s]
        assert len(x) == (n if n & (n - 1) == 0 else 512) and not any(x[n:])


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rest_once(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([16, 100, 2048]))
    hist = np.zeros(window + 1, np.int64)
    hist[1:] = rng.integers(0, [1, 4, 50, 1000, 3, 10 ** 6][seed] + 1, window) * (rng.random(window) < 0.5)
    plan = packing.plan(hist, window)
    first = {}
    for length, k, seq in zip(plan.key >> 48, plan.first, plan.sequence):
        first.setdefault(int(length), []).append((int(k), int(seq)))
    used = int((hist * np.arange(window + 1)).sum())
    assert plan.sequences >= used / window
    if hist.sum() <= 50000:
        fill = defaultdict(list)
        for length in np.flatnonzero(hist):
            k = np.arange(hist[length])
            s, o = plan.place(np.full(len(k), length, np.int64), k)
            for a, b in zip(s.tolist(), o.tolist()):
                fill[a].append((b, int(length)))
        assert sorted(fill) == list(range(plan.sequences))
        for spans in fill.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= window


@pytest.mark.parametrize("lo, hi, many", [(1, 600, 40), (30, 120, 400), (300, 500, 60), (300, 500, 4000), (5, 9, 9000),
                                          (700, 1000, 200)])
def test_short_rests_are_placed_by_the_least_squares(lo, hi, many):
    """The plan, not the greedy residual, packs corpora of short documents."""
    rng = np.random.default_rng(lo)
    hist = np.zeros(2049, np.int64)
    hist[lo:hi + 1] = rng.poisson(many, hi + 1 - lo)
    plan = packing.plan(hist)
    used = int((hist * np.arange(2049)).sum())
    best = max(-(-used // 2048), -(-int(hist.sum()) // (2048 // lo)))
    if (lo, hi) == (700, 1000):  # two fit, three do not: no combination fills a window
        assert plan.sequences == -(-int(hist.sum()) // 2) and plan.solved == 0
    else:
        assert plan.solved >= 0.9 * plan.sequences and plan.sequences <= 1.01 * best + 1


def test_deep_combinations_fill_the_window():
    hist = np.zeros(2049, np.int64)
    hist[[31, 64, 90, 111]] = [5, 9, 2, 7]
    for h in (hist, np.r_[0, np.ones(40, np.int64), np.zeros(2008, np.int64)]):
        rows = packing.deep_combinations(h)
        assert len(rows) and (rows.sum(1) == 2048).all() and (h[rows[rows > 0]] > 0).all()
    assert len(packing.deep_combinations(np.zeros(2049, np.int64))) == 0


def test_rounding_keeps_the_sum():
    x = np.random.default_rng(0).random(1000) * 0.4
    assert abs(packing.rounded(x).sum() - x.sum()) <= 1 and packing.rounded(np.array([2.0, 0.0, 1.0])).tolist() == [2, 0, 1]


def test_least_squares_fits_a_solvable_histogram():
    hist = np.zeros(101, np.int64)
    hist[[30, 70, 50]] = [40, 40, 20]
    combos = packing.combinations(np.flatnonzero(hist), 100)
    x = packing.solve(combos, hist)
    fitted = np.zeros(101)
    for c, n in zip(combos, x):
        for length in c[c > 0]:
            fitted[length] += n
    assert np.abs(fitted - hist).max() < 0.5 and (x >= 0).all()
    assert packing.plan(hist, 100).sequences == 50
