import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from isobar.llm import risk_rules as rr

BLANK = " \t\n\x0b\x0c\r"


def plain(text):
    words = [w for w in re.split(f"[{BLANK}]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    again = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
            "base_failed": len(words) < 50 or 100 * len(again) > 50 * len(words)}


def test_measures(spark, docs, edge):
    more = spark.createDataFrame([(100, "a b c a b c a b c d\n a b\na b\n\n \na b"), (101, "a a a a a"),
                                  (102, "x y z x y"), (103, "\x0ba\x0cb\x1fc é f"), (104, "#*$%&|<>")],
                                 "doc_id long, text string").withColumn("lang", F.lit("q"))
    for df in (docs, edge, more):
        got = sorted((tuple(str(r[c]) for c in ("doc_id", *plain(""))) for r in
                      rr.measures(df, F.col("lang")).collect()))
        want = sorted(tuple(map(str, (r.doc_id, *plain(r.text).values()))) for r in df.collect())
        assert got == want


def cdf(k, n, p):
    """Exact sum in logarithms."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
            + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(x - top) for x in logs)


def test_binomial(spark):
    cases = [(0, 1, .3), (0, 500, .005), (3, 2000, .005), (9, 10, .95), (20, 30000, .001), (4800, 1_000_000, .005)]
    for k, n, p in cases:
        df = spark.createDataFrame([(float(k), float(n))], "k double, n double")
        got = df.select(rr.binomial_cdf(F.col("k"), F.col("n"), p)).first()[0]
        assert got == pytest.approx(cdf(k, n, p), rel=1e-7)


def ratio(a, b):
    return a / b if b else 0.0


def test_cutoffs_and_verdict_against_plain_search(spark):
    d = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    stratum = F.col("lang")
    rows = rr.staged(rr.measures(documents, stratum), "test-risk")
    alpha, delta = 0.04, 0.05
    cuts = rr.cutoffs(rows, labels, alpha, delta)
    chosen = {r.stratum: r for r in cuts.collect()}
    m = rows.toPandas()
    m["symbol_share"] = [ratio(a, b) for a, b in zip(m.n_symbols, m.word_chars)]
    m["dup_line_share"] = [ratio(a, b) for a, b in zip(m.n_dup_lines, m.n_lines)]
    m["repeat_share"] = [ratio(a, b) for a, b in zip(m.n_repeat_words, m.n_words)]
    m["mean_word"] = [ratio(a, b) for a, b in zip(m.word_chars, m.n_words)]
    held = m[~m.base_failed].merge(labels.toPandas(), on="doc_id")
    key = dict(zip(documents.toPandas().doc_id, documents.toPandas().text))
    tests = len(set(held.stratum))
    want = {}
    for s, part in held.groupby("stratum"):
        texts = defaultdict(lambda: [False, None])
        for r in part.itertuples():
            t = texts[key[r.doc_id]]
            t[0], t[1] = t[0] or r.quality > 0, r
        good, bad = ([t[1] for t in texts.values() if t[0] == g] for g in (True, False))
        best = None
        for i in range(rr.STEPS):
            lost, caught = (sum(any(getattr(r, k) > c[i] for k, c in rr.LADDERS.items()) for r in some)
                            for some in (good, bad))
            if lost >= len(good) * alpha or cdf(lost, len(good), alpha) > delta / tests:
                break
            if caught and (best is None or caught > best[0]):
                best = (caught, i)
        if best:
            want[s] = {k: c[best[1]] for k, c in rr.LADDERS.items()}
    assert len(want) >= 3  # several strata have labels enough
    got = {s: {k: r[f"cut_{k}"] for k in rr.LADDERS} for s, r in chosen.items()}
    assert got == want
    verdict = {r.doc_id: r.kept for r in rr.judge(rows, cuts).collect()}
    for r in m.itertuples():
        over = any(getattr(r, k) > c for k, c in want.get(r.stratum, {}).items())
        assert verdict[r.doc_id] == (not r.base_failed and not over)
    clean = held[held.quality > 0]
    assert sum(verdict[i] for i in clean.doc_id) >= (1 - alpha) * len(clean)


def test_repeated_rows_and_labels_change_nothing(spark):
    """Repetition is no evidence: few labels many times allow no more than few labels once."""
    d = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    rows = rr.staged(rr.measures(documents, F.col("lang")), "test-risk")
    once = sorted(map(tuple, rr.cutoffs(rows, labels, 0.1).collect()))
    again = spark.range(16).select(F.col("id").alias("k"))
    assert once == sorted(map(tuple, rr.cutoffs(rows, labels.join(again), 0.1).collect()))
    assert once == sorted(map(tuple, rr.cutoffs(rows.join(again), labels, 0.1).collect()))
    copies = rows.join(again).withColumn("doc_id", F.col("doc_id") + 1_000_000 * F.col("k"))
    more = labels.join(again).withColumn("doc_id", F.col("doc_id") + 1_000_000 * F.col("k"))
    assert once == sorted(map(tuple, rr.cutoffs(copies, more, 0.1).collect()))


def test_a_text_labelled_both_ways_is_good(spark):
    rows = rr.measures(spark.createDataFrame([(1, "w%d " % 0 + "x y z v " * 20 + "#"), (2, "a")],
                                             "doc_id long, text string"), F.lit("s"))
    rows = rows.withColumn("base_failed", F.lit(False))
    lab = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert sorted(r.good for r in rr.holdout(rows, lab).collect()) == [False, True]


def test_oracle_where_several_strata_choose(spark):
    import duckdb

    from isobar.llm import queries

    d = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    want = {(r[0], r[-1]) for r in con.execute(
        f"SELECT doc_id, kept FROM ({queries.ORACLE['op6_quality_rules']})").fetchall()}
    out = queries.op6_quality_rules(spark, d).select("doc_id", "kept", "base_failed").collect()
    assert {(r.doc_id, r.kept) for r in out} == want
    assert sum(not r.kept and not r.base_failed for r in out) > 0


def test_edge_cases(edge, empty, labels):
    got = rr.report(edge, labels)
    assert got.count() == edge.count() and rr.report(empty, labels).count() == 0
    assert all(r.kept == (not r.base_failed) for r in rr.report(edge, labels.filter("false")).collect())
    assert not any(x in n for n in ("Python", "Arrow", "Pandas")
                   for x in [got._jdf.queryExecution().executedPlan().toString()])
