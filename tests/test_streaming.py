"""Structured Streaming forms: ingest once, keyed upsert, speed layer."""

import glob
import os

import pytest

from pyspark.sql import functions as F

from isobar.operators import speed
from isobar.plans import jobs
from isobar.sources import sinks
from isobar.sources.raw import raw_schema, with_source
from isobar.streaming import ingest, patch
from isobar.streaming.latest import latest_state
from tests.feed_fixture import FILE_A, FILE_B, FILE_C, TOKENS, record, write_avon, write_file

GLOB = "{*feed-1*,*feed3-4*}"


def raw_stream(spark, landing):
    return ingest.read_files(spark, f"{landing}/*/*/*/*", raw_schema(), fmt="json",
                             glob=GLOB, max_files=1)


def test_ingest_each_file_once(spark, workdir):
    landing = write_avon(os.path.join(workdir, "landing"), only=[FILE_A, FILE_B])
    sink, ck = os.path.join(workdir, "sink"), os.path.join(workdir, "ck")
    tr = lambda df: with_source(df).select("path", "source", "current_observation.temp_f")
    ingest.ingest(spark, f"{landing}/*/*/*/*", sink, ck, raw_schema(), glob=GLOB, transform=tr)
    assert spark.read.parquet(sink).count() == 4
    write_avon(landing, only=[FILE_C])
    ingest.ingest(spark, f"{landing}/*/*/*/*", sink, ck, raw_schema(), glob=GLOB, transform=tr)
    ingest.ingest(spark, f"{landing}/*/*/*/*", sink, ck, raw_schema(), glob=GLOB, transform=tr)
    df = spark.read.parquet(sink)
    assert df.count() == 5
    assert sorted(r["source"] for r in df.select("source").distinct().collect()) == \
        [2017030815, 2017030816, 2017030817]


def test_latest_state_and_page_patch(spark, workdir):
    """Three micro-batches log what they change and touch no text."""
    landing = write_avon(os.path.join(workdir, "landing"), only=[FILE_A, FILE_B, FILE_C])
    pages = os.path.join(workdir, "pages")
    html = "<html><h1>Avon</h1><h2>50.0&deg;F</h2></html>"
    rows = [("avon", html)] + [(f"town{i}", "<h2>1.0&deg;F</h2>") for i in range(40)]
    patch.publish_text(spark.createDataFrame(rows, "slug string, html string"), pages, "slug")
    base = sinks.manifest(spark, pages)["parts"]
    readings = with_source(raw_stream(spark, landing)).select(
        F.col("current_observation.display_location.city").alias("city"),
        F.col("current_observation.local_epoch").cast("bigint").alias("ts"),
        F.col("current_observation.temp_f").cast("double").alias("temp"))
    state = latest_state(readings.filter(F.col("city") != ""), "city", "ts", ["temp"])
    fn = patch.patch_texts({pages: (speed.heading_pattern, speed.heading_replacement)})
    ingest.run_available_now(patch.slugged(state), os.path.join(workdir, "ck"),
                             batch_fn=fn, output_mode="update")
    got = dict(map(tuple, patch.read_text_table(spark, pages).collect()))
    assert got["avon"] == "<html><h1>Avon</h1><h2>47.0&deg;F</h2></html>" and len(got) == 41
    assert all(got[f"town{i}"] == "<h2>1.0&deg;F</h2>" for i in range(40))
    parts = sinks.manifest(spark, pages)["parts"]
    assert parts[:1] == base and [(k, n) for k, _, n in parts[1:]] == [("log", 1)] * fn.updated
    assert 1 <= fn.updated <= 3


def test_state_is_on_disk_and_a_killed_query_resumes(spark, workdir):
    """The second micro-batch dies after its state was updated; the restarted query gives what one
    that never died gives."""
    src, ck = workdir + "/src", workdir + "/ck"
    rows = [(k, t, 1000 * t + k) for t in range(4) for k in range(500) if (k + t) % 3]
    for t in range(4):
        df = spark.createDataFrame([r for r in rows if r[1] == t], "k int, ts int, v int")
        df.coalesce(1).write.json(f"{src}/{t}")
    stream = latest_state(ingest.read_files(spark, f"{src}/*", "k int, ts int, v int", max_files=1), "k", "ts", ["v"])
    sunk, dies = {}, [True]

    def sink(batch, batch_id):
        got = {r.k: (r.ts, r.v) for r in batch.collect()}
        if batch_id == 1 and dies:
            dies.pop()
            raise RuntimeError("lost")
        sunk[batch_id] = got

    with pytest.raises(Exception, match="lost"):
        ingest.run_available_now(stream, ck, batch_fn=sink, output_mode="update")
    assert sorted(sunk) == [0]
    q = ingest.run_available_now(stream, ck, batch_fn=sink, output_mode="update")
    state = {}
    for batch in sorted(sunk):
        state.update(sunk[batch])
    want = {}
    for k, t, v in rows:
        want[k] = max(want.get(k, (t, v)), (t, v))
    assert state == want and sorted(sunk) == [0, 1, 2, 3]
    op = q.lastProgress["stateOperators"][0]
    assert any(m.startswith("rocksdb") for m in op["customMetrics"]) and op["numRowsTotal"] == 500
    assert glob.glob(f"{ck}/state/0/*/*.changelog")


def test_a_provider_that_was_set_stays(spark):
    was = spark.conf.get(ingest.STATE_PROVIDER)
    spark.conf.set(ingest.STATE_PROVIDER, "org.example.Other")
    ingest.state_on_disk(spark)
    assert spark.conf.get(ingest.STATE_PROVIDER) == "org.example.Other"
    spark.conf.set(ingest.STATE_PROVIDER, was)


def test_counters_of_micro_batches_also_after_a_replay(spark, workdir, monkeypatch):
    landing, st, ck = (os.path.join(workdir, n) for n in ("landing", "store", "ck"))
    write_avon(landing, only=[FILE_A, FILE_B])
    record_files, calls = jobs._record, []

    def dying(*args):
        calls.append(1)
        record_files(*args)
        if len(calls) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "_record", dying)
    with pytest.raises(Exception, match="lost"):
        jobs.stream_normalize_job(spark, landing, st, ck, TOKENS, max_files=1)
    jobs.stream_normalize_job(spark, landing, st, ck, TOKENS, max_files=1)
    write_avon(landing, only=[FILE_C])
    jobs.stream_normalize_job(spark, landing, st, ck, TOKENS, max_files=1)
    rows = sinks.read_parts(spark, f"{jobs.open_store(spark, st)}/batches").collect()
    got = {(r.batch, r.name): r.value for r in rows}
    assert len(got) == len(rows) and {b for b, _ in got} == {0, 1, 2} and {r["query"] for r in rows} == {ck}
    assert [sum(v for (_, n), v in got.items() if n == name) for name in
            ("records", "rejected_blank", "rejected_corrupt", "rows_observation")] == [5, 2, 0, 3]
    assert all(got[b, "touched_dates"] >= 1 for b in range(3))


def test_stream_normalize_job_equals_batch(spark, workdir):
    landing = os.path.join(workdir, "landing")
    st = os.path.join(workdir, "stream-store")
    for only in ([FILE_B], [FILE_C, FILE_A]):
        write_avon(landing, only=only)
        jobs.stream_normalize_job(spark, landing, st, os.path.join(workdir, "ck"), TOKENS, max_files=1)
    st_batch = os.path.join(workdir, "batch-store")
    jobs.normalize_job(spark, write_avon(os.path.join(workdir, "land2")), st_batch, TOKENS)
    a, b = jobs.load_tables(spark, st), jobs.load_tables(spark, st_batch)
    for name in a:
        ra = sorted(map(tuple, a[name].collect()), key=str)
        rb = sorted(map(tuple, b[name].collect()), key=str)
        assert ra == rb, name


def test_stream_takes_the_files_batch_takes(spark, workdir):
    """A token in a folder name, any depth, and characters that URLs escape."""
    landing = os.path.join(workdir, "land ing")
    write_file(landing, "feed-1/deep er/2017/03/08/15/a%20b.json",
               [record("Avon", 1489006920, "50.0", "49.3", "23%", "10.0", [(1489010400, 51, 50, 25, 12)])])
    write_file(landing, "other/2017/03/08/15/c", [record("Vail", 1489006920, "1.0", "1.0", "1%", "1.0")])
    tables = []
    for name, job in (("s", lambda st: jobs.stream_normalize_job(spark, landing, st, workdir + "/ck", TOKENS)),
                      ("b", lambda st: jobs.normalize_job(spark, landing, st, TOKENS)),
                      ("r", lambda st: jobs.rebuild_job(spark, landing, st, TOKENS))):
        st = os.path.join(workdir, name)
        job(st)
        tables.append({n: sorted(map(str, df.collect())) for n, df in jobs.load_tables(spark, st).items()})
        # whoever ingested first, the batch job finds nothing new
        assert jobs.normalize_job(spark, landing, st, TOKENS)["files"] == 0
    assert tables[0] == tables[1] == tables[2] and len(tables[0]["observation"]) == 1


def test_speed_job_patches_pages_and_index(spark, workdir):
    """The report publishes the texts; later readings are patched into both."""
    landing, st, out = (os.path.join(workdir, n) for n in ("landing", "store", "out"))
    write_avon(landing, only=[FILE_A])
    jobs.normalize_job(spark, landing, st, TOKENS)
    jobs.analyze_job(spark, st)
    jobs.report_job(spark, st, out)
    assert patch.read_text_table(spark, f"{out}/pages").first()["html"] == "<h1>Avon</h1><h2>50.0&deg;F</h2>"
    write_avon(landing, only=[FILE_B])
    assert jobs.speed_job(spark, landing, out, os.path.join(workdir, "ck"), TOKENS) == 1
    assert patch.read_text_table(spark, f"{out}/pages").first()["html"] == "<h1>Avon</h1><h2>52.5&deg;F</h2>"
    assert patch.read_text_table(spark, f"{out}/index_lines").first()["html"] == (
        '&nbsp;&nbsp;52.5&deg;F&nbsp;&nbsp;<a href="avon.html">Avon</a><br>')


def test_stream_then_incremental_analyze_equals_full(spark, workdir):
    landing = os.path.join(workdir, "landing")
    st = os.path.join(workdir, "store")
    ck = os.path.join(workdir, "ck")
    write_avon(landing, only=[FILE_A])
    jobs.stream_normalize_job(spark, landing, st, ck, TOKENS, max_files=1)
    jobs.analyze_job(spark, st)                       # first, full
    write_avon(landing, only=[FILE_B, FILE_C])
    jobs.stream_normalize_job(spark, landing, st, ck, TOKENS, max_files=1)
    inc = {r["fhours"]: tuple(r) for r in jobs.analyze_pending(spark, st).collect()}
    again = {r["fhours"]: tuple(r) for r in jobs.analyze_pending(spark, st).collect()}
    full = {r["fhours"]: tuple(r) for r in jobs.analyze_job(spark, st).collect()}
    assert set(inc) == set(full) == {1, 2}
    for k in full:
        assert inc[k] == pytest.approx(full[k]) and again[k] == pytest.approx(full[k])
