"""Incremental ingest: each micro-batch is an append of its own size, the latest versions are a view.

A micro-batch reads nothing of the table and shuffles only its own rows.  The versions that have been overtaken
are folded away when the appends hold more bytes than the part folded before, so what folding rewrites stays in proportion
to what has arrived, however many micro-batches it came in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.curate import first_of_each, latest_versions
from ..sources.store import TableStore

#: Column with the number of the micro-batch that brought a row.
ARRIVAL = "arrival"


def current(versions: DataFrame, keys: list[str], newest_first: list[str], id_col: str = "id") -> DataFrame:
    """The newest version of each key; of equally new ones the first to arrive, then the smaller id.

    Rows with a null key are left out, as in :func:`~curatrix.operators.curate.latest_versions`; a row that was
    in the table before any stream counts as arrived first.
    """
    order = [F.desc_nulls_last(c) for c in newest_first] + [F.asc_nulls_first(ARRIVAL), F.asc_nulls_last(id_col)]
    return first_of_each(versions, keys, order, keep_null_keys=False)


def fold(store: TableStore, table: str, keys: list[str], newest_first: list[str]) -> None:
    """Leave the newest version of each key in the table."""
    store.replace(table, current(store.read(table), keys, newest_first))


def ingest(
    stream: DataFrame,
    store: TableStore,
    table: str,
    keys: list[str],
    newest_first: list[str],
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame] = lambda df: df,
    once: bool = True,
    fold_at: float = 1.0,
) -> StreamingQuery:
    """Append arriving records to ``table``, whose latest versions :func:`current` gives.

    A micro-batch that is replayed after a failure replaces what it left: its append has an id made of the
    checkpoint and the batch's number.  Replayed after a fold, it adds versions that are there already, which
    the view does not show twice.  ``fold_at`` is the share of appended to folded bytes at which the table is folded.
    An empty micro-batch adds no rows.  A table made elsewhere gets the column ``arrival``.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def step(batch: DataFrame, number: int) -> None:
        fresh = latest_versions(clean(batch), keys, newest_first).withColumn(ARRIVAL, F.lit(number).cast("long"))
        if store.exists(table):
            store.add_columns(table, {ARRIVAL: "long"})
        store.append_or_create(table, fresh, f"{name}-{number}")
        folded, appended = store.sizes(table)
        if appended > fold_at * folded:
            fold(store, table, keys, newest_first)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
