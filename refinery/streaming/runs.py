"""The newest run of each subcategory as a stream of files (S1 with ST2)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from refinery.functions import text as X
from refinery.sources.files import RUN
from refinery.sources.sinks import BatchStore

RUNS = "main string, sub string, run_id string, path string, replaces boolean"


def _newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Files of the newest run that the key has had so far; ``replaces`` where it is newer than any before this batch."""
    before = state.get[0] if state.exists else ""
    best, paths = before, []
    for rows in batches:
        top = max(best, rows["run_id"].max())
        if top > best:
            best, paths = top, []
        paths += rows.loc[rows["run_id"] == best, "path"].tolist()
    state.update((best,))
    if paths:
        yield pd.DataFrame({"main": key[0], "sub": key[1], "run_id": best, "path": paths, "replaces": best > before})


def newest_runs(files: DataFrame) -> DataFrame:
    """From a stream of (path): what each batch adds to the newest runs, as RUNS. Files of older runs, however late, are dropped.

    The state is one run id for each (main, sub). Where ``replaces`` is set, the key's earlier rows no longer count.
    """
    parts = files.select("path", *[X.path_part(F.col("path"), RUN, n).alias(c) for n, c in enumerate(("main", "sub", "run_id"), 1)]).where("run_id <> ''")
    return parts.groupBy("main", "sub").applyInPandasWithState(_newest, RUNS, "run_id string", "append", GroupStateTimeout.NoTimeout)


def put_runs(store: BatchStore, added: DataFrame, number: int, source: str) -> bool:
    """Brings a table of (main, sub, run_id, path) up to date with a batch of ``newest_runs``; the same batch again changes nothing.

    The table's one batch is rewritten as a whole; readers see it before or after, and its commit holds the
    batch's number. Whether anything was applied.
    """
    done = [e["notes"]["number"] for e in store.log.entries() if e.get("notes", {}).get("source") == source]
    if number <= max(done, default=-1):
        return False
    keys = ["main", "sub"]
    newer = added.where("replaces").select(*keys).distinct()
    kept = store.current().join(newer, keys, "left_anti")
    store.overwrite(kept.unionByName(added.select(*kept.columns)).distinct(), "runs", {"source": source, "number": number})
    return True


def keep_newest(files: DataFrame, store: BatchStore, checkpoint: str, source: str = "crawl") -> StreamingQuery:
    """Runs over the files that have arrived since the checkpoint, then stops."""

    def put(added: DataFrame, number: int) -> None:
        added = added.persist()
        try:
            put_runs(store, added, number, source)
        finally:
            added.unpersist()

    return newest_runs(files).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
