"""Operator 12 against scoring every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from isobar.llm import lexical as X


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(w), len(w)) for d, t in docs if (w := split(t))]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        rows = []
        for doc, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in split(text) if t in bag)
            if s > 0:
                rows.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    docs = [(i // 2, " ".join(rng.choice(vocab, rng.integers(1, 60), p=p / p.sum()))) for i in range(900)]
    docs += [(5000 + i, "w7 w250 same words in a large group of copies") for i in range(300)]
    docs += [(None, "w250 W251 null id"), (1, None), (2, ""), (3, "--- ..."), (4, "é É w299")]
    items = [(i, " ".join(rng.choice(vocab, 8))) for i in range(20)]
    items += [(100, "w7 w7 same copies"), (100, "w7 w7 same copies"), (100, "w250"), (None, "w251 null"), (101, None),
              (102, ""), (103, "unheard"), (104, "É é W299"), (105, " ".join(vocab))]
    return docs, items


@pytest.mark.parametrize("docs_a_segment, block", [(X.SEGMENT_DOCS, X.BLOCK), (1, 3), (64, 1)])
def test_equals_scoring_everything(spark, corpus, monkeypatch, docs_a_segment, block):
    docs, items = corpus
    monkeypatch.setattr(X, "SEGMENT_DOCS", docs_a_segment)
    monkeypatch.setattr(X, "BLOCK", block)
    d = spark.createDataFrame([(*x, 1, "r") for x in docs], "doc_id long, text string, n int, terms string")
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, query int")
    assert got(X.search(d, q)) == brute(docs, items)


def test_several_blocks_of_queries(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    assert got(X.search(d, q, k=3, query_bytes=300)) == brute(docs, items, 3)


def test_summaries_skip_documents_of_other_clusters():
    """Documents of another topic are neither scored nor opened once k good ones are known."""
    topics, size = 20, 200
    ids = np.arange(topics * size)
    term = np.concatenate([np.array([0, 1 + i // size]) for i in ids])
    impact = np.tile([400, 900], len(ids))
    segment = X.Segment(ids, np.zeros(len(ids), bool), np.arange(len(ids) + 1) * 2, term, impact,
                        np.full(topics + 1, 1000))
    b = segment.blocked(0)
    assert sorted(b.docs) == list(ids) and (np.diff(b.first) <= X.BLOCK).all()
    top = X.Best(20)
    scored = X.search_segment(segment, [[(0, 1), (5, 1)]], [top])
    assert top.ids.tolist() == list(range(4 * size, 4 * size + 20)) and scored <= size


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 9, 400)
    at = np.r_[0, np.cumsum(size)]
    term = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in size])
    segment = X.Segment(np.arange(400), np.zeros(400, bool), at, term, rng.integers(1, 1000, len(term)),
                        rng.integers(1, 1000, 40))
    query = rng.integers(0, 3, 40) * segment.weight
    for t in range(40):
        b = segment.blocked(t)
        bound = X.sums(query[b.terms] * b.most, b.width)
        for i in range(len(b.first) - 1):
            assert segment.score(b.docs[b.first[i]:b.first[i + 1]], query).max() <= bound[i]


def test_edge_rows_and_empty_tables(spark, edge, empty):
    items = [(1, "the cat word"), (2, "日本 one 567"), (3, None)]
    q = spark.createDataFrame(items, "item_id long, text string")
    assert got(X.search(edge, q)) == brute([(r.doc_id, r.text) for r in edge.collect()], items)
    assert got(X.search(empty, q)) == [] and got(X.search(edge, q.limit(0))) == []


def test_test_tables(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert got(X.search(docs, bench)) == brute([(r.doc_id, r.text) for r in docs.collect()],
                                               [(r.item_id, r.text) for r in bench.collect()])
