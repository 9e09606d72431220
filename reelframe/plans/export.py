"""Export of document trees to the flat table, resumable by document name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from reelframe.operators.sets import skip_processed
from reelframe.session import scratch_path
from reelframe.sources.documents import flatten_document_tree, tree_faults


def export_documents(trees: DataFrame, done: DataFrame | None, rows_path: str, progress_path: str,
                     errors_path: str | None = None, run: str | None = None) -> None:
    """Flattens ``trees(file_key, tree, processed_at)`` that are not in ``done`` and notes them as finished.

    The documents of a run are fixed first, so what arrives meanwhile is left to the
    next run. A run writes folders of its own, named ``run``: after a failure the same
    name replaces what was half written. Only documents that gave rows are noted; the
    others go to ``errors_path`` and are tried again the next time.
    """
    run = run or uuid.uuid4().hex
    todo = trees if done is None else skip_processed(trees, done, "file_key")
    path = scratch_path(trees.sparkSession, "export")
    todo.write.parquet(path)
    todo = trees.sparkSession.read.parquet(path)
    faults = tree_faults(todo, "file_key", "tree")
    flatten_document_tree(todo, "tree").write.mode("overwrite").csv(f"{rows_path}/run={run}", header=True, escape='"')
    if errors_path:
        faults.write.mode("overwrite").json(f"{errors_path}/run={run}")
    skip_processed(todo, faults, "file_key").select("file_key", "processed_at") \
        .write.mode("overwrite").parquet(f"{progress_path}/run={run}")
