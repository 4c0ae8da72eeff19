"""Plan shapes that matter at scale, and results under a hot key (one key
holding a third of the rows)."""

import random

import pandas as pd
from pyspark.sql import functions as F

from isobar.operators import keys, verify
from tests.test_verify import brute, close


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_events(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else rnd.randint(1, 50)
        rows.append((i, user, 1704067200 + rnd.randint(0, 48 * 3600), round(rnd.uniform(0, 99), 2)))
    return rows


def test_persistence_skill_has_no_join_and_is_exact_under_a_hot_key(spark):
    rows = _hot_events(spark)
    obs = spark.createDataFrame(rows, "id long, u long, t long, v double") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    got = verify.persistence_skill(obs, "u", "ts", {"x": F.col("v")}, {"x": F.floor("v")}, 24)
    plan = _plan(got)
    assert "Join" not in plan
    assert "partial_" in plan or "HashAggregate" in plan
    fc = pd.DataFrame([{"key": str(u), "fts": (t // 3600) * 3600 + k * 3600, "fhours": k,
                        "x": float(int(v))} for _, u, t, v in rows for k in range(1, 25)])
    ac = pd.DataFrame([{"key": str(u), "ts": (t // 3600) * 3600, "x": v} for _, u, t, v in rows])
    want = brute(fc, ac, ["x"])
    g = {r["fhours"]: r for r in got.collect()}
    assert set(g) == set(want)
    for lead, w in want.items():
        assert g[lead]["count"] == w["count"]
        assert close(w["xM"], g[lead]["xM"]) and close(w["xSD"], g[lead]["xSD"])


def test_enforce_under_a_hot_key(spark):
    rows = _hot_events(spark)
    df = spark.createDataFrame(rows, "id long, u long, t long, v double").repartition(8)
    got = {r["u"]: r["id"] for r in keys.enforce(df, ["u"], "t", tiebreak=["id"]).collect()}
    want = {}
    for i, u, t, v in rows:
        if u not in want or (t, i) > want[u]:
            want[u] = (t, i)
    assert got == {u: i for u, (t, i) in want.items()}


def test_skill_join_is_one_to_one_on_moments(spark):
    fc = spark.createDataFrame([("a", 3600 * (i % 5), 1 + i % 3, float(i)) for i in range(200)],
                               "city string, fts long, fhours int, temp double")
    ac = spark.createDataFrame([("a", 3600 * (i % 5), float(i)) for i in range(300)],
                               "city string, ts long, temp double")
    plan = _plan(verify.skill(fc, ac, ["city"], ["temp"]))
    # both join inputs are aggregates (moments), never raw rows
    join = plan.split("Join")[1]
    assert join.count("HashAggregate") >= 2
