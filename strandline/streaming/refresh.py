"""Window replacement as a stream sink: each micro-batch replaces the date windows that it brings."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.windows import replace_window
from ..plans import storage


def replacing_sink(stream: DataFrame, root: Path, date_column: str, checkpoint: str) -> DataStreamWriter:
    """A writer that merges each batch into the partition root/data; a batch that comes twice changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        manifest_path, folder = root / "_manifest.json", root / "data"
        with storage.archive_lock(root):
            storage.recover(batch.sparkSession, root)
            manifest = storage.read_json(manifest_path) or {"partitions": {}}
            span = batch.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi")).first()
            if span["lo"] is None:
                return
            rows = batch
            if "data" in manifest["partitions"]:
                rows = replace_window(storage.read_partition(batch.sparkSession, folder), batch, date_column, span["lo"], span["hi"])
            storage.commit_partition(root, folder, manifest_path, manifest, "data", rows, {"batch": batch_id, "window": [span["lo"], span["hi"]]}, f"batch-{batch_id}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
