"""Table sinks: committed tables (S7), landing JSON.

A table is immutable files made visible by small numbered commits. Each write
adds a folder ``ver=<id>`` (with ``<part>=<value>`` in it) and then creates the
file of the next number under ``_commits``, which names the current folder of
every part. Readers take the highest number, so they never see half a write, a
crash before the commit changes nothing, and nothing that is being read is ever
overwritten or removed. Old files go only when :func:`vacuum` is called.

Any number of writers may work at a time. A commit file is created only if
there is none, so of two writers one is first. The other looks at what
changed: if those were other parts it commits on top; if they were the parts
that it had read, it does its work again on what is there now
(:func:`rewrite`, :func:`merge_into`). No clock is compared.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isobar.session import tasks_for
from isobar.sources import fs

COMMITS = "_commits"
VERSION = "ver"  # folder level (and hidden partition column) of a write
NULL_PART = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for NULL


# Parts that a task may have open at a time.
OPEN_FILES = 40
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class Conflict(RuntimeError):
    """Another writer changed what a replacement was computed from."""


# --------------------------------------------------------------------- commits

def commits(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in fs.list_names(spark, f"{path}/{COMMITS}")
                  if n.startswith("v") and n.endswith(".json"))


def newest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest commit; ``(0, None)`` if nothing was ever committed."""
    c = commits(spark, path)
    return (int(c[-1][1:-5]), json.loads(fs.read_text(spark, f"{path}/{COMMITS}/{c[-1]}"))) if c else (0, None)


def try_commit(spark: SparkSession, path: str, after: int, content: dict) -> bool:
    """Make ``content`` the commit that follows number ``after``, unless another writer did."""
    return fs.create_new(spark, f"{path}/{COMMITS}/v{after + 1:020d}.json", json.dumps(content))


# ---------------------------------------------------------------------- tables

def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest commit: ``schema``, ``partition_by`` and ``parts``, a list of
    ``[value, folder]``; None if nothing was ever committed."""
    return newest(spark, path)[1]


def _parts(m: dict | None) -> dict:
    return {} if m is None else {v: f for v, f in m["parts"]}


def intact(spark: SparkSession, path: str) -> bool:
    """Whether the table was committed and all folders of the commit are there."""
    m = manifest(spark, path)
    return m is not None and not lost_parts(spark, path)


def lost_parts(spark: SparkSession, path: str) -> list:
    """Parts of the newest commit whose folder is gone."""
    m = manifest(spark, path)
    if m is None:
        return []
    there = set(fs.glob_names(spark, path, "*/*" if m["partition_by"] else "*"))
    return [v for v, folder in m["parts"] if folder not in there]


def _read(spark: SparkSession, path: str, m: dict | None, parts: Sequence | None = None) -> DataFrame | None:
    if m is None:
        return None
    schema = StructType.fromJson(m["schema"])
    wanted = None if parts is None else set(parts)
    folders = [f for v, f in m["parts"] if wanted is None or v in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return df.select(*schema.fieldNames())


def read_parts(spark: SparkSession, path: str, parts: Sequence | None = None) -> DataFrame | None:
    """S6 on a committed table, typed as written; None if there is none.

    ``parts`` lists the partition values wanted (None among them is the NULL
    partition): only their folders are listed and opened.
    """
    return _read(spark, path, manifest(spark, path), parts)


def folders(spark: SparkSession, path: str) -> dict:
    """Partition value -> folder of the table's newest commit; a folder's content never changes."""
    return _parts(manifest(spark, path))


def read_folders(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Rows of folders that are or were parts of the table, with its present schema."""
    m = manifest(spark, path)
    return _read(spark, path, {**m, "parts": [[None, f] for f in wanted]})


def drop_parts(spark: SparkSession, path: str, values: Sequence) -> None:
    """Take the parts ``values`` away."""
    base = newest(spark, path)
    if values and base[1] is not None:
        _commit(spark, path, base, StructType.fromJson(base[1]["schema"]), base[1]["partition_by"], values, {}, False)


def _commit(spark: SparkSession, path: str, base: tuple[int, dict | None], schema: StructType,
            partition_by: str | None, values: Sequence | None, written: dict, checked: bool) -> bool:
    """Replace the parts ``values`` (None: all) by the folders ``written``, as a commit
    after ``base``. If there are newer commits, the parts they changed
    are kept; False if one of ``values`` is among them and ``checked`` is asked for."""
    number, m = base
    before, gone = _parts(m), None if values is None else set(values)
    while True:
        now = _parts(m)
        if checked and now != before and (gone is None or any(now.get(v) != before.get(v) for v in gone)):
            return False
        kept = {} if gone is None else {v: f for v, f in now.items() if v not in gone}
        if try_commit(spark, path, number, {"schema": schema.jsonValue(), "partition_by": partition_by,
                                            "parts": list({**kept, **written}.items())}):
            return True
        number, m = newest(spark, path)


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of equal ``cols`` side by side, but no more than AQE's advisory size in a
    task: small groups share a task, a hot one is split."""
    names = ", ".join(f"`{c}`" for c in cols)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{df}}", df=df)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """A task that writes several parts has up to ``most`` of them open, and sorts only what goes to further ones."""
    was = spark.conf.get(_WRITERS)
    try:
        if most:
            spark.conf.set(_WRITERS, str(most))
        yield
    finally:
        spark.conf.set(_WRITERS, was)


def _write(df: DataFrame, path: str, partition_by: str | None, dealt: bool = False) -> dict:
    """Write a new folder, with one in it per part; returns part value -> folder. No other
    writer uses that folder, so writers do not meet in Spark's temporary files. Rows that are
    ``dealt`` already, a part to few tasks, are not shuffled again."""
    spark, folder = df.sparkSession, f"{VERSION}={uuid.uuid4().hex}"
    if not partition_by:
        df.write.option("compression", "zstd").parquet(f"{path}/{folder}")
        return {None: folder}
    df = df if dealt else rebalanced(df, partition_by)
    with _open_files(spark, OPEN_FILES if dealt else 0):
        df.write.option("compression", "zstd").partitionBy(partition_by).parquet(f"{path}/{folder}")
    parts = {}
    for part in fs.glob_names(spark, path, f"{folder}/{partition_by}=*"):
        value = part.split("/")[1].partition("=")[2]
        parts[None if value == NULL_PART else unquote(value)] = part
    return parts


def write_parts(df: DataFrame, path: str, partition_by: str | None = None, dealt: bool = False) -> None:
    """Replace the whole table by ``df``. Of several writers the last one stays. ``dealt``: rows of
    a part are with few tasks already."""
    base = newest(df.sparkSession, path)
    _commit(df.sparkSession, path, base, df.schema, partition_by, None, _write(df, path, partition_by, dealt), False)


def write_table(df: DataFrame, root: str, name: str, partition_by: str | None = None) -> str:
    """Publish ``df`` as the next version of table ``name``; returns its path."""
    path = f"{root.rstrip('/')}/{name}"
    write_parts(df, path, partition_by)
    return path


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """S6 on a published table: the newest version, or None."""
    return read_parts(spark, f"{root.rstrip('/')}/{name}")


def replace_parts(df: DataFrame, path: str, partition_by: str, values: Sequence,
                  base: tuple[int, dict | None] | None = None) -> None:
    """Replace the parts ``values`` by the rows of ``df``, which are all in them; a
    part without rows goes. With ``base``, the :func:`newest` commit when
    ``df`` was planned, raises :class:`Conflict` if one of the parts changed since."""
    spark = df.sparkSession
    if not _commit(spark, path, base or newest(spark, path), df.schema, partition_by, values,
                   _write(df, path, partition_by), base is not None):
        raise Conflict(path)


def rewrite(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame],
            partition_by: str | None = None, values: Sequence | None = None, dealt: bool = False) -> None:
    """Replace the parts ``values`` (None: the whole table) by ``build(rows)``, where ``rows`` are the
    parts' current rows (None before the first commit). If another writer changes them meanwhile it is
    built again from the new ones, so no update is lost."""
    while True:
        base = newest(spark, path)
        df = build(_read(spark, path, base[1], values))
        if _commit(spark, path, base, df.schema, partition_by, values, _write(df, path, partition_by, dealt), True):
            return


def merge_into(new: DataFrame, path: str, keys, version: str = "source",
               partition_by: str | None = None, tiebreak=None) -> list:
    """Keyed upsert of ``new`` into the committed table at ``path``: per key
    the row with the highest ``version`` wins (W1), whatever the arrival
    order, so that repeating a merge changes nothing, and merges at the same time
    give what one after the other gives. Returns the partition values touched.

    With ``partition_by`` (a column of every key, e.g. the date) only the
    parts that the new rows touch are opened and rewritten. Their values are
    the one thing the driver collects: as many as a batch has dates. ``new``
    is read twice, so cache or stage it when it is dear. A large merge is shuffled once,
    by ranges of part and key, which serve the keys and the writing.
    """
    from isobar.operators.keys import enforce

    touched, many = None, 0
    if partition_by:
        found = dict(new.groupBy(partition_by).count().collect())
        touched, many = list(found), sum(found.values())

    def build(current: DataFrame | None) -> DataFrame:
        rows = new if current is None else current.select(*new.columns).unionByName(new)
        if large:
            first = [partition_by, *[k for k in keys if k != partition_by]]
            tasks = tasks_for(many + (0 if current is None else current.count()))
            rows = rows.repartitionByRange(tasks, *first)
        return enforce(rows, keys, version, tiebreak)

    large = tasks_for(many) > 1
    rewrite(new.sparkSession, path, build, partition_by, touched, dealt=large)
    return touched or []


# ----------------------------------------------------------------------- marks

def marks(spark: SparkSession, path: str) -> dict[str, str]:
    """A small set kept in commits alone: value -> token of the writer that marked it last."""
    now = newest(spark, path)[1]
    return {} if now is None else dict(now["marks"])


def mark(spark: SparkSession, path: str, values: Sequence[str], token: str) -> None:
    _edit_marks(spark, path, lambda now: {**now, **{v: token for v in values}})


def unmark(spark: SparkSession, path: str, seen: dict[str, str]) -> None:
    """Take away the marks of ``seen`` that nobody renewed."""
    _edit_marks(spark, path, lambda now: {v: t for v, t in now.items() if seen.get(v) != t})


def _edit_marks(spark: SparkSession, path: str, edit: Callable[[dict], dict]) -> None:
    while True:
        number, now = newest(spark, path)
        before = {} if now is None else now["marks"]
        after = edit(before)
        if after == before or try_commit(spark, path, number, {"marks": after}):
            return


# ---------------------------------------------------------------------- vacuum

def vacuum(spark: SparkSession, path: str, older_than_s: float = 7 * 86400) -> int:
    """Remove what is superseded since ``older_than_s`` seconds: commits, and the folders that
    only those commits name. The newest state always stays. Jobs call it with the
    default; call it with less only when nothing older is being read."""
    limit = time.time() * 1000 - older_than_s * 1000
    made = fs.modified(spark, f"{path}/{COMMITS}")
    names = [n for n in sorted(made) if n.startswith("v") and n.endswith(".json")]
    # a commit is superseded when the next one is made
    gone = {a for a, b in zip(names, names[1:]) if made[b] <= limit}
    if not gone:
        return 0

    def folders(commit):
        return commit_folders(json.loads(fs.read_text(spark, f"{path}/{COMMITS}/{commit}")))

    named = {n: folders(n) for n in names}
    keep = set().union(*[named[n] for n in names if n not in gone])
    drop = set().union(*[named[n] for n in gone]) - keep
    for f in sorted(drop):
        fs.delete(spark, f"{path}/{f}")
    for f in {f.split("/")[0] for f in drop if "/" in f}:
        if not fs.list_dirs(spark, f"{path}/{f}"):  # the write has no part left
            fs.delete(spark, f"{path}/{f}")
    for n in sorted(gone):
        fs.delete(spark, f"{path}/{COMMITS}/{n}")
    return len(drop)


def commit_folders(content: dict) -> set[str]:
    """Folders that a commit of a table, of a text table or of marks names."""
    return {f for _, f, *_ in content.get("parts", [])}


# --------------------------------------------------------------------- landing

def land_json(df: DataFrame, path: str, partition_by=None,
              build: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Records as newline-delimited JSON (one object per row), gzipped. With
    ``partition_by`` (the hour folders of a landing area) rows of one folder
    are written by few tasks, and a hot hour by as many as its size needs. ``build`` makes the
    records, row by row, of rows that are dealt and sorted before, while they are narrow."""
    w = rebalanced(df, *partition_by).sortWithinPartitions(*partition_by) if partition_by else df
    w = (w if build is None else build(w)).write.mode("append").option("compression", "gzip")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
