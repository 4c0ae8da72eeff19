"""The store under crashes, losses, late data and concurrent readers."""

import os

import pytest
from pyspark.sql import functions as F

from isobar import session
from isobar.plans import jobs
from isobar.sources import fs, sinks
from tests.feed_fixture import FILE_A, FILE_B, FILE_C, TOKENS, record, write_avon, write_file


def content(spark, store):
    out = {n: sorted(map(str, df.collect())) for n, df in jobs.load_tables(spark, store).items()}
    base = jobs.open_store(spark, store)
    out["newest"] = sorted(map(str, sinks.read_parts(spark, f"{base}/newest").collect()))
    return out


def stats(df):
    return sorted(tuple(None if v is None else round(v, 9) for v in r) for r in df.collect())


@pytest.fixture()
def whole(spark, workdir):
    """Tables and statistics of a rebuild over all files, with the landing folder."""
    landing = write_avon(os.path.join(workdir, "landing"))
    store = os.path.join(workdir, "whole")
    jobs.rebuild_job(spark, landing, store, TOKENS)
    return landing, content(spark, store), stats(jobs.analyze_job(spark, store))


@pytest.mark.parametrize("step, when", [(0, "after"), (3, "before"), (5, "after"), (6, "before")])
def test_a_crash_at_any_commit_is_redone(spark, workdir, whole, monkeypatch, step, when):
    """Dies before or after the commit of each table (and of the pair sums)."""
    landing, tables, want = whole
    store = os.path.join(workdir, "store")
    write_avon(workdir + "/land1", only=[FILE_A])
    jobs.hourly_run(spark, workdir + "/land1", store, workdir + "/out", TOKENS)
    commit, calls = sinks._commit, []

    def dying(*args):
        calls.append(args[1])
        if len(calls) == step + 1 and when == "before":
            raise RuntimeError("lost")
        done = commit(*args)
        if len(calls) == step + 1:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(sinks, "_commit", dying)
    with pytest.raises(RuntimeError):
        jobs.normalize_job(spark, landing, store, TOKENS)
        jobs.analyze_pending(spark, store)
    monkeypatch.setattr(sinks, "_commit", commit)
    jobs.normalize_job(spark, landing, store, TOKENS)
    got = jobs.analyze_pending(spark, store)
    assert content(spark, store) == tables and stats(got) == want


def test_touched_dates_survive_a_run_that_ends_before_the_analysis(spark, workdir, whole):
    landing, _, want = whole
    store = os.path.join(workdir, "store")
    jobs.normalize_job(spark, landing, store, TOKENS)  # and nothing more
    jobs.hourly_run(spark, landing, store, workdir + "/out", TOKENS)
    base = jobs.open_store(spark, store)
    assert stats(sinks.read_latest(spark, base, "stats")) == want


@pytest.mark.parametrize("name", ["observation", "newest"])
def test_a_lost_table_is_rebuilt(spark, workdir, whole, name):
    _, tables, want = whole
    landing, store = os.path.join(workdir, "land2"), os.path.join(workdir, "store")
    write_avon(landing, only=[FILE_A, FILE_B])
    jobs.normalize_job(spark, landing, store, TOKENS)
    jobs.analyze_job(spark, store)
    fs.delete(spark, jobs.table_path(spark, store, name))
    write_avon(landing, only=[FILE_C])
    m = jobs.normalize_job(spark, landing, store, TOKENS)
    assert m["rebuilt"] == 1 and m["files"] == 0  # the rebuild took the new file too
    assert content(spark, store) == tables
    assert stats(jobs.analyze_pending(spark, store)) == want


def test_a_lost_partition_counts_as_damage(spark, workdir):
    landing, store = write_avon(workdir + "/landing"), workdir + "/store"
    jobs.normalize_job(spark, landing, store, TOKENS)
    assert not jobs.damaged(spark, store)
    path = jobs.table_path(spark, store, "forecast")
    fs.delete(spark, f"{path}/{sinks.manifest(spark, path)['parts'][0][1]}")
    assert jobs.damaged(spark, store)


@pytest.mark.parametrize("name, part, fed", [
    ("forecast", "2017-03-09", [1]), ("observation", "2017-03-08", [0, 2]), ("cityDay", "2017-03-08", [0, 2]),
    ("city", None, [0, 1, 2]), ("newest", None, [])])
def test_a_lost_part_is_filled_from_the_files_that_fed_it(spark, workdir, monkeypatch, name, part, fed):
    landing, store = workdir + "/landing", workdir + "/store"
    e, day = 1489006920, 24 * 3600  # 2017-03-08, 15:02 local
    write_file(landing, "2017/03/08/15/feed-1-a", [
        record("Avon", e, "50.0", "49.0", "23%", "10.0", [(e + 3600, 51, 50, 25, 12)]),
        record("", e, "1.0", "1.0", "1%", "1.0")])
    write_file(landing, "2017/03/09/15/feed-1-b", [
        record("Avon", e + day, "53.0", "49.0", "23%", "10.0", [(e + day + 3600, 52, 50, 25, 12), (None, 1, 1, 1, 1)])])
    write_file(landing, "2017/03/10/15/feed-1-c", [
        record("Avon", e, "55.0", "49.0", "23%", "10.0", [(e + 7200, 54, 50, 25, 12)])])
    jobs.normalize_job(spark, landing, store, TOKENS)
    want, base = content(spark, store), jobs.open_store(spark, store)
    scores = stats(jobs.analyze_pending(spark, store))
    path = f"{base}/{name}"
    fs.delete(spark, f"{path}/{dict(sinks.manifest(spark, path)['parts'])[part]}")
    read, real = [], jobs.read_raw
    monkeypatch.setattr(jobs, "read_raw", lambda s, p: read.extend(p) or real(s, p))
    monkeypatch.setattr(jobs, "BATCH_FILES", 1)  # several batches are put together
    m = jobs.normalize_job(spark, landing, store, TOKENS)
    assert sorted(p.partition("feed-1-")[2] for p in read) == ["abc"[i] for i in fed]
    assert (m["rebuilt"], m["healed_parts"], m["refilled_files"], m["missing_files"]) == (0, 1, len(fed), 0)
    assert jobs.open_store(spark, store) == base and content(spark, store) == want
    assert not jobs.damaged(spark, store) and stats(jobs.analyze_pending(spark, store)) == scores
    jobs.rebuild_job(spark, landing, store, TOKENS)
    assert content(spark, store) == want


def test_a_ledger_without_dates_leads_to_a_rebuild(spark, workdir):
    landing, store = write_avon(workdir + "/landing"), workdir + "/store"
    jobs.normalize_job(spark, landing, store, TOKENS)
    want, base = content(spark, store), jobs.open_store(spark, store)
    old = sinks.read_parts(spark, f"{base}/path").select("path", "day")
    sinks.write_parts(session.staged(old, "old"), f"{base}/path", "day")
    write_file(landing, "2017/03/08/17/feed-1-z", [record("", 1489006920, "1.0", "1.0", "1%", "1.0")])
    jobs.normalize_job(spark, landing, store, TOKENS)  # entries with and without dates side by side
    assert sinks.read_parts(spark, f"{base}/path").filter("fdates IS NULL").count() == old.count()
    path = f"{base}/observation"
    fs.delete(spark, f"{path}/{sinks.manifest(spark, path)['parts'][0][1]}")
    assert jobs.normalize_job(spark, landing, store, TOKENS)["rebuilt"] == 1
    assert content(spark, store) == want


def test_every_reject_is_a_row_with_its_file(spark, workdir):
    landing = workdir + "/landing"
    blank, other = record("", 1, "1", "1", "1%", "1"), {"almanac": {"airport_code": "X"}}
    path = write_file(landing, FILE_A, [record("Avon", 1489006920, "50.0", "49.0", "23%", "10.0"), blank, blank, other])
    with open(path, "a") as fh:
        fh.write('{"broken\n')
    write_file(landing, FILE_B, [blank])
    tables = []
    for name, job in (("n", jobs.normalize_job), ("r", jobs.rebuild_job),
                      ("s", lambda s, land, st, t: jobs.stream_normalize_job(s, land, st, workdir + "/ck", t))):
        store = f"{workdir}/{name}"
        job(spark, landing, store, TOKENS)
        base = jobs.open_store(spark, store)
        rows = sinks.read_parts(spark, f"{base}/rejects").collect()
        tables.append(sorted((r.path[-10:], r.source, r.reason, r.n, r.digest) for r in rows))
        assert [r.record for r in rows if r.reason == "corrupt"] == ['{"broken']
        assert [r.record for r in rows if r.n == 1 and r.source == 2017030815 and r.reason == "blank"] == [
            '{"almanac":{"airport_code":"X"}}']
    assert tables[0] == tables[1] == tables[2]
    assert sorted((p, r, n) for p, _, r, n, _ in tables[0]) == sorted([
        (FILE_A[-10:], "blank", 2), (FILE_A[-10:], "blank", 1), (FILE_A[-10:], "corrupt", 1), (FILE_B[-10:], "blank", 1)])
    raw = jobs.read_raw(spark, [path]).persist()
    jobs.merge_raw(spark, raw, jobs.open_store(spark, workdir + "/n"), "again")  # a run that died before the ledger
    again = sinks.read_parts(spark, f"{jobs.open_store(spark, workdir + '/n')}/rejects")
    assert again.count() == 4 and again.agg(F.sum("n")).first()[0] == 5


def test_a_rebuild_leaves_no_stale_statistics(spark, workdir):
    landing, store = workdir + "/landing", workdir + "/store"
    write_avon(landing)
    jobs.normalize_job(spark, landing, store, TOKENS)
    assert jobs.analyze_job(spark, store).count() == 2
    other = write_file(workdir + "/other", FILE_A, [record("Vail", 1489006920, "1.0", "1.0", "1%", "1.0")])
    jobs.rebuild_job(spark, other[: other.index("/2017/")], store, TOKENS)
    assert jobs.analyze_job(spark, store, dates=[]).count() == 0
    assert jobs.analyze_job(spark, store).count() == 0


def test_incremental_scoring_finds_any_lead(spark, workdir):
    landing, store = workdir + "/landing", workdir + "/store"
    e = 1489006920
    lead = 14 * 24 * 3600
    write_file(landing, "2017/03/08/15/feed-1-a",
               [record("Avon", e, "50.0", "49.0", "23%", "10.0", [(e - e % 3600 + lead, 51, 50, 25, 12)])])
    jobs.normalize_job(spark, landing, store, TOKENS)
    jobs.analyze_pending(spark, store)
    write_file(landing, "2017/03/22/15/feed-1-b", [record("Avon", e + lead, "53.0", "49.0", "23%", "10.0")])
    m = jobs.normalize_job(spark, landing, store, TOKENS)
    got = jobs.analyze_pending(spark, store)
    assert m["touched_dates"] == ["2017-03-22"]
    assert [(r["fhours"], r["tempM"]) for r in got.collect()] == [(14 * 24, 2.0)]
    assert stats(got) == stats(jobs.analyze_job(spark, store))


def test_readers_keep_their_files(spark, workdir):
    df = spark.range(5)
    sinks.write_table(df, workdir, "t")
    first = sinks.read_latest(spark, workdir, "t")
    for _ in range(4):
        sinks.write_table(spark.range(9), workdir, "t")
    assert first.count() == 5 and sinks.read_latest(spark, workdir, "t").count() == 9
    path = workdir + "/c"
    sinks.write_parts(df.withColumn("p", F.lit("a")), path, "p")
    old = sinks.read_parts(spark, path)
    for _ in range(3):
        sinks.replace_parts(spark.range(9).withColumn("p", F.lit("a")), path, "p", ["a"])
    assert old.count() == 5 and sinks.read_parts(spark, path).count() == 9
    assert sinks.vacuum(spark, path) == 0 and old.count() == 5
    assert sinks.vacuum(spark, path, older_than_s=0) == 3
    assert sinks.vacuum(spark, workdir + "/t", older_than_s=0) == 4
    assert sinks.read_parts(spark, path).count() == 9 and sinks.read_latest(spark, workdir, "t").count() == 9


def test_parts_with_odd_values(spark, workdir):
    rows = [("a b/c=d%20", 1, 1), (None, 1, 1), ("é:x", 1, 1)]
    schema = "p string, k int, source int"
    sinks.merge_into(spark.createDataFrame(rows, schema), workdir + "/t", ["p", "k"], partition_by="p")
    sinks.merge_into(spark.createDataFrame([(p, k, 2) for p, k, _ in rows], schema), workdir + "/t", ["p", "k"],
                     partition_by="p")
    got = sinks.read_parts(spark, workdir + "/t").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(p, k, 2) for p, k, _ in rows], key=str)
    assert sinks.intact(spark, workdir + "/t")
    assert sinks.read_parts(spark, workdir + "/t", ["é:x"]).count() == 1
    sinks.replace_parts(spark.createDataFrame([], schema), workdir + "/t", "p", [None])
    assert sinks.read_parts(spark, workdir + "/t").count() == 2


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_the_report_opens_only_the_days_it_needs(spark, workdir):
    """One city went silent months ago; its last day is one more part, no more."""
    landing, store = workdir + "/landing", workdir + "/store"
    e = 1489006920
    day = 86400
    for i in range(12):
        recs = [record("Avon", e + i * day, str(40.0 + i), "1.0", "1%", "1.0",
                       [(e + i * day + 3600 * k, 40, 40, 50, 5) for k in range(1, 251)])]
        if i == 0:
            recs.append(record("Dead", e, "7.0", "1.0", "1%", "1.0", [(e + 3600, 8, 8, 50, 5)]))
        write_file(landing, f"2017/03/{8 + i:02d}/15/feed-1-{i}", recs)
    jobs.normalize_job(spark, landing, store, TOKENS)
    got = jobs.report_inputs(spark, store)
    for name, most in (("observation", 2), ("cityDay", 2), ("forecast", 13)):
        path = jobs.table_path(spark, store, name)
        plan = got[name]._jdf.queryExecution().executedPlan().toString()
        opened = int(plan.split("InMemoryFileIndex(")[1].split(" paths")[0])
        total = len(sinks.manifest(spark, path)["parts"])
        assert opened <= most < total, name
    t = jobs.load_tables(spark, store)
    assert sorted(map(str, jobs.latest_forecasts(got["forecast"]).collect())) == sorted(
        map(str, jobs.latest_forecasts(t["forecast"]).collect()))
    cur = {r["city"]: r["temp"] for r in got["observation"].collect()}
    assert cur == {"Avon": 51.0, "Dead": 7.0}


def test_a_hot_hour_is_written_by_several_tasks(spark, workdir):
    """A third of the rows in one hour: more than one file there, few files elsewhere."""
    key, n = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = spark.conf.get(n)
    spark.conf.set(key, "64k")
    spark.conf.set(n, "64")  # as sized: partitions of about the advisory size
    try:
        hour = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("h"), (F.col("id") % 40).cast("string")))
        df = spark.range(0, 30000, numPartitions=8).select(
            hour.alias("hour"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        sinks.land_json(df, workdir + "/land", partition_by=["hour"])
        sinks.write_parts(df, workdir + "/t", "hour")
    finally:
        spark.conf.unset(key)
        spark.conf.set(n, before)
    for path in (workdir + "/land", workdir + "/t"):
        n = {}
        for d, _, names in os.walk(path):
            hour = [p for p in d.split("/") if p.startswith("hour=")]
            if hour:
                n[hour[0]] = n.get(hour[0], 0) + sum(x.startswith("part-") for x in names)
        assert n["hour=hot"] > 1
        others = [v for k, v in n.items() if k != "hour=hot"]
        assert sum(others) <= 3 * len(others)  # about as many as hours, not one a task each


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_scratch_paths_are_not_reused(spark):
    a = session.staged(spark.range(3), "x")
    b = session.staged(spark.range(4), "x")
    assert a.count() == 3 and b.count() == 4
