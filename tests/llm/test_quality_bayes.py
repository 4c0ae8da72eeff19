import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import quality_bayes as q


def test_finds_labelled_quality(spark):
    d = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = q.classify(documents, labels, F.col("source"), F.col("lang")).join(
        labels.select("doc_id", F.col("quality").alias("good")), "doc_id").collect()
    assert sum(r.kept == bool(r.good) for r in got) >= 0.98 * len(got)
    clean = [r for r in got if r.good]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)


def test_priors_against_plain_sums(spark):
    rng = np.random.default_rng(1)
    rows = [(h, p, float(x)) for h, n, m in (("big", 400, 0.9), ("bad", 60, 0.1), ("rare", 2, 0.5), (None, 5, 0.7))
            for p in ("x", None) for x in np.clip(rng.normal(m, 0.05, n), 0, 1)]
    priors, mean = q.site_priors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {(r.host, r.path): r for r in priors.collect()}
    assert len(got) == 8
    assert mean == pytest.approx(np.mean([r[2] for r in rows]))
    hosts = {}
    for h in ("big", "bad", "rare", None):
        p = [r[2] for r in rows if r[0] == h]
        hosts[h] = (len(p), sum(p))
    n = len(rows)
    spread = sum(k * (s / k - mean) ** 2 for k, s in hosts.values()) / n
    strength = q._strength(mean, spread, mean * (1 - mean) * 4 / n)
    for (h, _), r in got.items():
        k, s = hosts[h]
        assert r.host_prior == pytest.approx((s + strength * mean) / (k + strength))
    # a sparse site stays near the global mean, a large one near its own
    assert abs(got["big", "x"].prior - 0.9) < 0.02
    assert abs(got["rare", "x"].prior - mean) < abs(0.5 - mean)


def test_edge_cases(spark, edge, empty, labels):
    got = q.classify(edge, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == edge.count() and all(0 <= r.quality <= 1 for r in got)
    assert q.classify(empty, labels, F.col("source"), F.col("lang")).count() == 0
    none = labels.filter("false")
    assert all(r.kept for r in q.classify(edge, none, F.col("source"), F.col("lang")).collect())
    kept = q.good(edge, none, F.col("source"), F.col("lang"))
    assert kept.columns == edge.columns and kept.count() == edge.count()
    odd = spark.createDataFrame([(1, None, None), (None, 1, 0), (2, 1, 1), (2, 0, 0)],
                                "doc_id long, quality int, toxic int")
    assert q.classify(edge, odd, F.col("source"), F.col("lang")).count() == edge.count()


def test_good_agrees_with_classify(docs, labels):
    args = (labels, F.col("source"), F.col("lang"))
    kept = {r.doc_id for r in q.classify(docs, *args).filter("kept").collect()}
    assert {r.doc_id for r in q.good(docs, *args).collect()} == kept and 0 < len(kept) < docs.count()


@pytest.mark.parametrize("good", [0, 1])
@pytest.mark.parametrize("texts", [1, 300])
def test_an_often_repeated_labelled_id_does_not_fill_the_sample(spark, good, texts):
    tidy, noisy = "The cat sat on the mat and went away. ", "#$ %% 99 #$ !! "
    many = [(1, (tidy if good else noisy) * (1 + i % texts)) for i in range(300)]
    rest = [(i, (tidy if i % 2 else noisy) * (1 + i % 7)) for i in range(2, 42)]
    documents = spark.createDataFrame(many + rest, "doc_id long, text string")
    labels = spark.createDataFrame([(1, good)] * 300 + [(i, i % 2) for i in range(2, 42)], "doc_id long, quality int")
    model = q.fit(documents, labels, fit_rows=60)
    one, *others = (model.logits(q.features(t)[None])[0] for t in (tidy * 3, noisy * 3))
    assert one > 1 and others[0] < -1
    rate = 1 / (1 + np.exp(-model.prior))
    assert 0.2 < rate < 0.8


def test_picks_deal_texts_of_ids_in_turn(spark):
    rows = [(i, 1, i) for i in range(1, 6)] + [(9, 0, h) for h in range(100, 3100)]
    texts = spark.createDataFrame(rows, "id long, good int, h long")
    got = sorted(map(tuple, q._picks(texts, 8).collect()))
    assert got[:5] == rows[:5] and len(got) == 8 and got[5] == (9, 0, 100)
    assert sorted(map(tuple, q._picks(texts, 10_000).collect())) == sorted(rows)
    assert sorted({r.id for r in q._picks(texts, 3).collect()}) != [9]


def test_url_site(spark):
    df = spark.createDataFrame([("https://A.example.com:80/fr/825?page=2",), ("http://b.org",), (None,)], "url string")
    host, path = q.url_site("url")
    assert [tuple(r) for r in df.select(host, path).collect()] == [
        ("a.example.com", "fr"), ("b.org", ""), (None, None)]


def test_repetition_features_against_sets():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 40, 200_000):
        words = [rng.choice("abcdefgh") * rng.choice([1, 2]) for _ in range(n)]
        m = max(n, 1)
        f = q.features(" ".join(words))
        got = [f[-10], f[-7], f[-4], f[-3]]
        want = [len(set(words)) / m, len(set(zip(words, words[1:]))) / m,
                sum(a == b for a, b in zip(words, words[1:])) / m,
                len(set(zip(words, words[1:], words[2:]))) / m]
        assert got == want
