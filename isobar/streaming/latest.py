"""ST2: the newest reading per key as streaming state (the speed layer).

A streaming aggregation keeps one row per key in the state store:
``max(struct(ts, tiebreak, values...))`` picks the newest reading with a
total order. It is an ordinary hash aggregate, so partial aggregation runs
before the shuffle and a hot key costs one state row. The store is on disk with
a log of changes (:func:`isobar.streaming.ingest.state_on_disk`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_state(stream: DataFrame, key: str, ts: str, values: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: ``ts``, ``tiebreak`` and ``values`` of the
    newest row (by ``ts`` then ``tiebreak``)."""
    packed = F.struct(*[F.col(c) for c in (ts, *tiebreak, *values)])
    return (stream.groupBy(key).agg(F.max(packed).alias("_newest"))
            .select(key, "_newest.*"))
