"""The hand-computed fixture (FIXTURES.md §3) through all three jobs."""

import math
import os

import pytest
from pyspark.sql import functions as F

from isobar.plans import jobs
from tests.feed_fixture import FILE_A, FILE_B, FILE_C, TOKENS, record, write_avon, write_file


@pytest.fixture()
def store(spark, workdir):
    landing = write_avon(os.path.join(workdir, "landing"))
    st = os.path.join(workdir, "store")
    m = jobs.normalize_job(spark, landing, st, TOKENS)
    assert m["files"] == 3
    return landing, st


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_normalised_tables(spark, store):
    _, st = store
    t = jobs.load_tables(spark, st)
    assert t["observation"].count() == 3
    assert t["forecast"].count() == 3
    city = t["city"].collect()
    assert len(city) == 1 and city[0]["source"] == 2017030817
    day = t["cityDay"].collect()
    assert len(day) == 1 and day[0]["record_high"] == "89" and day[0]["source"] == 2017030817
    assert rows(t["nearby"], "nearby") == [("Elm",), ("Oak",)]
    w = rows(t["observation"], "date", "time", "temp")
    assert w == [("2017-03-08", "15:02", 50.0), ("2017-03-08", "16:03", 52.5),
                 ("2017-03-08", "17:01", 47.0)]
    f = rows(t["forecast"], "time", "fdate", "ftime", "temp")
    assert f == [("15:02", "2017-03-08", "16:00", "51"), ("15:02", "2017-03-08", "17:00", "49"),
                 ("16:03", "2017-03-08", "17:00", "48")]


def test_reingest_adds_nothing(spark, store):
    landing, st = store
    before = {n: df.count() for n, df in jobs.load_tables(spark, st).items()}
    again = jobs.normalize_job(spark, landing, st, TOKENS)
    assert again["files"] == 0 and again["files_left"] == 0
    after = {n: df.count() for n, df in jobs.load_tables(spark, st).items()}
    assert before == after


def test_stats(spark, store):
    _, st = store
    s = {r["fhours"]: r for r in jobs.analyze_job(spark, st).collect()}
    assert set(s) == {1, 2}
    one, two = s[1], s[2]
    assert one["count"] == 2
    for name, mean, sd in [("temp", 0.25, 1.767767), ("humidity", 0.5, 3.535534),
                           ("wind_mph", 0.5, 4.949747), ("feelslike", 0.0, 2.828427)]:
        assert one[f"{name}M"] == pytest.approx(mean, abs=1e-6)
        assert one[f"{name}SD"] == pytest.approx(sd, abs=1e-6)
    assert two["count"] == 1
    assert (two["tempM"], two["humidityM"], two["wind_mphM"], two["feelslikeM"]) == (-2, 1, 3, -3)
    assert two["tempSD"] is None and two["feelslikeSD"] is None


def test_bands_and_report(spark, store):
    _, st = store
    jobs.analyze_job(spark, st)
    rep = jobs.report_tables(spark, st)
    b = {(r["fts"], r["fhours"]): r for r in rep["bands"].collect()}
    assert len(b) == 3
    # issue b, target 17:00 (lead 1)
    r = b[(1488992400, 1)]
    assert r["temp"] == 48
    assert (r["temp_lower"], r["temp_upper"]) == pytest.approx((44.535177, 51.464823), abs=1e-6)
    assert (r["humidity_lower"], r["humidity_upper"]) == pytest.approx((26.070354, 39.929646), abs=1e-6)
    assert (r["wind_mph_lower"], r["wind_mph_upper"]) == pytest.approx((0.298495, 19.701505), abs=1e-6)
    assert (r["feelslike_lower"], r["feelslike_upper"]) == pytest.approx((40.456283, 51.543717), abs=1e-6)
    # issue a, target 16:00 (lead 1)
    r = b[(1488988800, 1)]
    assert r["temp_lower"] == pytest.approx(47.5352, abs=1e-4)
    assert (r["humidity_lower"], r["humidity_upper"]) == pytest.approx((18.0704, 31.9296), abs=1e-4)
    assert (r["wind_mph_lower"], r["wind_mph_upper"]) == pytest.approx((2.2985, 21.7015), abs=1e-4)
    # issue a, target 17:00 (lead 2): SD NULL -> free bounds NULL, clamps hold
    r = b[(1488992400, 2)]
    assert r["temp_lower"] is None and r["temp_upper"] is None
    assert r["feelslike_lower"] is None and r["feelslike_upper"] is None
    assert (r["humidity_lower"], r["humidity_upper"]) == (0.0, 100.0)
    assert r["wind_mph_lower"] == 0.0 and r["wind_mph_upper"] is None
    sm = {r["label"]: r for r in rep["sun_moon"].collect()}
    assert (sm["Sun"]["Rise"], sm["Sun"]["Set"]) == ("5:48", "18:21")
    assert (sm["Moon"]["Rise"], sm["Moon"]["Set"]) == ("9:07", "")
    hist = {r["label"]: r for r in rep["history"].collect()}
    assert (hist["Low"]["normal"], hist["Low"]["record"], hist["Low"]["record_year"]) == ("33", "-12", "1961")
    assert (hist["High"]["normal"], hist["High"]["record"], hist["High"]["record_year"]) == ("61", "89", "1987")
    card = rep["card"].collect()
    assert [r["label"] for r in card] == ["City", "State", "Country", "Elevation", "Latitude",
                                          "Longitude", "Local Tz Offset"]
    assert [r["value"] for r in card][-1] == "-0600"
    idx = rep["index"].collect()
    assert [(r["city"], r["slug"], r["temp"]) for r in idx] == [("Avon", "avon", 47.0)]
    ft = rep["forecast_table"].collect()
    assert [r["hour"] for r in ft] == ["03/08 16:00", "03/08 17:00", "03/08 17:00"]


def test_incremental_equals_rebuild_and_order_free(spark, workdir):
    """Files delivered newest-first, one per run, give the same tables as a
    rebuild over all files at once."""
    landing = write_avon(os.path.join(workdir, "landing"))
    inc = os.path.join(workdir, "inc")
    for only in ([FILE_C], [FILE_B], [FILE_A]):
        lone = write_avon(os.path.join(workdir, "land-" + only[0].rsplit("-", 1)[-1]), only=only)
        jobs.normalize_job(spark, lone, inc, TOKENS)
    reb = os.path.join(workdir, "reb")
    jobs.rebuild_job(spark, landing, reb, TOKENS)
    a, b = jobs.load_tables(spark, inc), jobs.load_tables(spark, reb)
    for name in a:
        cols = [c for c in a[name].columns]
        ra = sorted(map(tuple, a[name].select(*cols).collect()), key=str)
        rb = sorted(map(tuple, b[name].select(*cols).collect()), key=str)
        assert ra == rb, name


def test_max_files_bounds_a_run(spark, workdir):
    landing = write_avon(os.path.join(workdir, "landing"))
    st = os.path.join(workdir, "store")
    first = jobs.normalize_job(spark, landing, st, TOKENS, max_files=2)
    assert (first["files"], first["files_left"]) == (2, 1)
    assert jobs.normalize_job(spark, landing, st, TOKENS, max_files=2)["files"] == 1
    assert jobs.normalize_job(spark, landing, st, TOKENS, max_files=2)["files"] == 0
    assert jobs.load_tables(spark, st)["observation"].count() == 3


def test_merge_reads_only_touched_partitions(spark, workdir, monkeypatch):
    from isobar.sources import sinks
    path = workdir + "/t"
    base = spark.range(300).select((F.col("id") % 30).cast("string").alias("date"),
                                   (F.col("id") % 7).alias("k"), F.lit(1).alias("source"), "id")
    sinks.merge_into(base, path, ["date", "k"], "source", partition_by="date")
    before = {v: f for v, f in sinks.manifest(spark, path)["parts"]}
    new = spark.createDataFrame([("3", 1, 2, 999), ("4", 100, 1, 5)],
                                "date string, k long, source int, id long")
    plans, write = [], sinks._write

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(sinks, "_write", spy)
    assert sorted(sinks.merge_into(new, path, ["date", "k"], "source", partition_by="date")) == ["3", "4"]
    # merge_into's own plan lists two folders of thirty
    assert "InMemoryFileIndex(2 paths)" in plans[0]
    after = {v: f for v, f in sinks.manifest(spark, path)["parts"]}
    assert {v for v in before if before[v] != after[v]} == {"3", "4"}
    out = sinks.read_parts(spark, path)
    assert out.count() == 30 * 7 + 1
    assert [(r["source"], r["id"]) for r in out.filter("date = '3' and k = 1").collect()] == [(2, 999)]


def test_report_job_publishes_versions_and_for_key(spark, store, workdir):
    from isobar.operators import reshape
    from isobar.sources import sinks
    _, st = store
    jobs.analyze_job(spark, st)
    out = workdir + "/report"
    paths = jobs.report_job(spark, st, out)
    assert set(paths) == {"bands", "card", "history", "sun_moon", "forecast_table", "index",
                          "current", "pages", "index_lines"}
    card = sinks.read_latest(spark, out, "card")
    assert reshape.for_key(card, "city", "Avon").count() == 7
    assert reshape.for_key(card, "city", "Vail").count() == 0
    assert sinks.read_latest(spark, out, "bands").count() == 3


def test_incremental_analyze_equals_full(spark, workdir):
    """Runs that each ingest one file and re-score only the touched dates
    give the statistics of a full re-score."""
    files = {}
    base = 1489006920
    for i in range(4):   # four deliveries across a day boundary (local clock)
        e = base + i * 3 * 3600
        fc = [(e + 3600 * k, 50 + (i + k) % 5, 48, 30 + k, 10 + i % 3) for k in range(1, 12)]
        files[f"2017/03/0{8 + (15 + 3 * i) // 24}/{(15 + 3 * i) % 24:02d}/feed-1-{i}"] = [
            record("Avon", e, str(49.0 + i), str(47.0 + i), f"{20 + i}%", str(9.0 + i), fc),
            record("Vail", e + 60, str(39.0 - i), str(37.0), f"{40 - i}%", str(4.0 + i), fc[:5])]
    inc_store = workdir + "/inc"
    for rel, recs in reversed(list(files.items())):   # newest first: late data for old dates
        land = write_file(workdir + "/land-" + rel.rsplit("-", 1)[-1], rel, recs)
        root = land[: land.index("/2017/")]
        m = jobs.normalize_job(spark, root, inc_store, TOKENS)
        assert m["touched_dates"]
        jobs.analyze_job(spark, inc_store, dates=m["touched_dates"])
    inc = {r["fhours"]: r for r in jobs.analyze_job(spark, inc_store, dates=[]).collect()}
    full = {r["fhours"]: r for r in jobs.analyze_job(spark, inc_store).collect()}
    assert set(inc) == set(full) and len(full) >= 3
    for k, f in full.items():
        for c, v in f.asDict().items():
            if v is None:
                assert inc[k][c] is None, (k, c)
            else:
                assert inc[k][c] == pytest.approx(v, abs=1e-9), (k, c)


def test_hourly_run_cycle(spark, workdir):
    from isobar.sources import sinks
    landing, store, out = workdir + "/landing", workdir + "/store", workdir + "/out"
    for only in ([FILE_A], [FILE_B], [FILE_C]):
        write_avon(landing, only=only)
        jobs.hourly_run(spark, landing, store, out, TOKENS)
    # the report of the last cycle used the stats of the cycle before
    assert sinks.read_latest(spark, out, "bands").count() >= 1
    stats = {r["fhours"]: r for r in sinks.read_latest(spark, jobs.open_store(spark, store), "stats").collect()}
    assert stats[1]["count"] == 2 and stats[2]["count"] == 1
    assert stats[1]["tempSD"] == pytest.approx(1.767767, abs=1e-6)


def test_command_line(spark, workdir):
    from isobar.__main__ import main
    landing = write_avon(workdir + "/landing")
    st, out = workdir + "/store", workdir + "/out"
    assert main(["normalize", "--landing", landing, "--store", st, "--token", "feed-1",
                 "--token", "feed3-4"], spark=spark)["files"] == 3
    assert main(["analyze", "--store", st], spark=spark)["stats_rows"] == 2
    paths = main(["report", "--store", st, "--out", out], spark=spark)
    assert "bands" in paths


def test_merge_keeps_null_partition_rows(spark, workdir):
    from isobar.sources import sinks
    path = workdir + "/t"
    schema = "date string, k long, source int, v string"
    sinks.merge_into(spark.createDataFrame([(None, 1, 1, "old1"), ("d1", 1, 1, "x")], schema),
                     path, ["date", "k"], "source", partition_by="date")
    sinks.merge_into(spark.createDataFrame([(None, 2, 1, "new2")], schema),
                     path, ["date", "k"], "source", partition_by="date")
    got = sorted((r["k"], r["v"]) for r in
                 sinks.read_parts(spark, path).filter("date is null").collect())
    assert got == [(1, "old1"), (2, "new2")]
