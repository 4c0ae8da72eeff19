"""ST3: keyed upsert as files arrive -- newest ``source`` wins per key.

Row-number windows are not allowed on a stream, so the window runs per
micro-batch inside ``foreachBatch``: the batch is merged into the table
with :func:`isobar.sources.sinks.merge_into`. The merge is idempotent, so a
micro-batch replayed after a failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from isobar.session import staged
from isobar.sources.sinks import merge_into


def upsert_fn(path: str, keys: Sequence[str], version: str = "source",
              partition_by: str | None = None,
              tiebreak: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function merging each micro-batch into ``path``."""
    def _merge(batch: DataFrame, batch_id: int) -> None:
        rows = staged(batch, "upsert")  # a stateful batch must not be computed twice
        if not rows.isEmpty():
            merge_into(rows, path, list(keys), version, partition_by, tiebreak)
    return _merge
