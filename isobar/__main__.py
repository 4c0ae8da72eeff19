"""Command line for the jobs, e.g. under spark-submit:

    spark-submit --py-files isobar.zip isobar/__main__.py hourly --landing L --store S --out O --token T
    python -m isobar hourly --landing L --store S --out O --token T      # local

``--token`` (repeatable) names the files to ingest: their path contains one of them.

Subcommands: normalize, rebuild, analyze, report, hourly, stream-normalize,
analyze-pending, speed. The session comes from spark-submit (master, shuffle
partitions, checkpoint folder); nothing here sets cluster resources.
"""

from __future__ import annotations

import argparse
import json

from isobar.plans import jobs
from isobar.session import get_session


def main(argv: list[str] | None = None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="isobar")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("normalize", "rebuild", "hourly", "stream-normalize", "speed"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--token", action="append", required=True, dest="tokens")
        if name != "speed":
            s.add_argument("--store", required=True)
        if name in ("normalize", "rebuild", "hourly", "stream-normalize"):
            s.add_argument("--keep-unknown", action="store_true", help="keep undeclared fields too")
        if name in ("normalize", "hourly"):  # all new files unless bounded
            s.add_argument("--max-files", type=int, default=None)
        if name in ("stream-normalize", "speed"):  # per micro-batch
            s.add_argument("--max-files", type=int, default=100)
        if name == "hourly":
            s.add_argument("--out", required=True)
        if name in ("stream-normalize", "speed"):
            s.add_argument("--checkpoint", required=True)
        if name == "speed":
            s.add_argument("--out", required=True, help="where report publishes its texts")
    for name in ("analyze", "analyze-pending", "report"):
        s = sub.add_parser(name)
        s.add_argument("--store", required=True)
        if name == "analyze":
            s.add_argument("--dates", nargs="*", default=None)
        if name == "report":
            s.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = spark or get_session(app=f"isobar-{a.job}")

    if a.job == "normalize":
        res = jobs.normalize_job(spark, a.landing, a.store, a.tokens, max_files=a.max_files,
                                 keep_unknown=a.keep_unknown)
    elif a.job == "rebuild":
        res = jobs.rebuild_job(spark, a.landing, a.store, a.tokens, a.keep_unknown)
    elif a.job == "hourly":
        res = jobs.hourly_run(spark, a.landing, a.store, a.out, a.tokens, max_files=a.max_files,
                              keep_unknown=a.keep_unknown)
    elif a.job == "stream-normalize":
        jobs.stream_normalize_job(spark, a.landing, a.store, a.checkpoint, a.tokens, a.max_files, a.keep_unknown)
        res = {"stream": "drained"}
    elif a.job == "speed":
        res = {"stream": "drained", "updated": jobs.speed_job(
            spark, a.landing, a.out, a.checkpoint, a.tokens, a.max_files)}
    elif a.job == "analyze":
        res = {"stats_rows": jobs.analyze_job(spark, a.store, dates=a.dates).count()}
    elif a.job == "analyze-pending":
        res = {"stats_rows": jobs.analyze_pending(spark, a.store).count()}
    else:
        res = jobs.report_job(spark, a.store, a.out)
    print(json.dumps(res, default=str))
    return res


if __name__ == "__main__":
    main()
