"""Keep a stored index current while documents arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.index_store import FAN, GRACE_SECONDS, add_documents, merge_loads, tidy_index


def keep_current(
    arriving: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "stream",
    order_by: str | None = None,
    available_now: bool = True,
    fan: int | None = FAN,
    grace_seconds: float = GRACE_SECONDS,
    **options,
) -> StreamingQuery:
    """Start a query that indexes each micro-batch of ``doc_id, text`` as one load of the index at ``path``.

    ``order_by`` names the column that picks among rows of one batch that share an id; without it ids must be unique
    in a batch. Of rows in different batches the earlier one stays.

    A batch that is run again after a failure replaces its own load, and ids that are known already are skipped, so
    a replay under a new checkpoint (give it another ``name``) changes nothing.

    After each batch loads of like size are merged as soon as there are ``fan`` of them (None: never), so that their
    number grows with the logarithm of that of the batches, and what no reader can need any more is deleted after
    ``grace_seconds``. Both leave open readers alone.
    """

    def index_batch(batch: DataFrame, number: int) -> None:
        add_documents(batch, path, f"{name}-{number:012d}", order_by, **options)
        if fan is not None:
            merge_loads(batch.sparkSession, path, fan)
        tidy_index(batch.sparkSession, path, grace_seconds)

    writer = arriving.writeStream.foreachBatch(index_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
