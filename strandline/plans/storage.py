"""Durable state on a shared file system: lock, JSON, partition directories, journaled publication.

A partition is a directory of Parquet files written by Spark into a staging folder beside it; it goes
live by two renames under a journal. Digests of its files are computed by a distributed scan.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import setops
from .contracts import ArchiveError

LOCK, JOURNALS = ".archive.lock", "_transactions"


class RecoveryError(ArchiveError):
    pass


@contextlib.contextmanager
def archive_lock(root: Path) -> Iterator[None]:
    """One writer at a time: the second one is refused at once."""
    root.mkdir(parents=True, exist_ok=True)
    with (root / LOCK).open("a+") as handle:
        try:
            fcntl.flock(handle, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise ArchiveError(f"{root} is in use by another run") from e
        yield


def write_json(path: Path, value: object) -> None:
    """Whole or not at all."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    with temporary.open("w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, sort_keys=True, indent=1)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)


def read_json(path: Path) -> dict:
    """An object, or {} if there is no file."""
    if not path.exists():
        return {}
    value = json.loads(path.read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ArchiveError(f"{path} holds no object")
    return value


def files_of(spark: SparkSession, folder: Path) -> list[dict]:
    """name, bytes and sha256 of each Parquet file of a directory, hashed on the executors."""
    if not folder.is_dir() or not any(folder.glob("*.parquet")):
        return []
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"file://{folder.absolute()}").select("path", "length", F.sha2("content", 256).alias("sha")).collect()
    return sorted(({"name": r["path"].rsplit("/", 1)[-1], "bytes": r["length"], "sha256": r["sha"]} for r in rows), key=lambda f: f["name"])


def digest(files: list[dict]) -> str:
    return hashlib.sha256(json.dumps(files, sort_keys=True).encode()).hexdigest() if files else ""


def read_partition(spark: SparkSession, folder: Path, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"file://{folder.absolute()}")


def write_partition(df: DataFrame, folder: Path) -> int:
    """Write to a fresh directory, read back, and check the number of rows. An empty frame leaves an empty file."""
    rows = df.count()
    df.write.option("compression", "zstd").parquet(f"file://{folder.absolute()}")
    for check in folder.glob(".*.crc"):  # the manifest's digests take their place
        check.unlink()
    if (back := read_partition(df.sparkSession, folder, df.schema).count()) != rows:
        raise ArchiveError(f"{folder}: wrote {rows} rows and read {back}")
    return rows


def commit_partition(root: Path, folder: Path, manifest_path: Path, manifest: dict, key: str, df: DataFrame, entry: dict, run_id: str) -> dict:
    """Publish a partition and its manifest together. Returns the new entry.

    Refuses if the live files are not those of the manifest. If rows, shape and duplicates are as
    before, the files stay byte for byte and only the metadata of the fetch changes. Else the old
    files, the old manifest and the added and removed rows are kept under the run's transaction.
    """
    spark = df.sparkSession
    old = manifest.get("partitions", {}).get(key)
    live = files_of(spark, folder)
    if old and digest(live) != old["digest"]:
        raise ArchiveError(f"{folder} differs from its manifest")
    if not old and live:
        raise ArchiveError(f"{folder} is not in the manifest")
    df = df.distinct()
    place = root / JOURNALS / f"{run_id}-{uuid.uuid4().hex[:8]}"
    staged = place / "new"
    rows = write_partition(df, staged)
    fresh = read_partition(spark, staged, df.schema)
    summary = {"old_rows": 0, "new_rows": rows, "added": rows, "removed": 0, "old_duplicate_rows": 0}
    if old:
        before = read_partition(spark, folder)
        if setops.same_shape(before, fresh):
            summary = setops.change_summary(before, fresh).first().asDict()
        else:
            summary |= {"old_rows": before.count(), "removed": before.distinct().count()}
        if setops.same_shape(before, fresh) and not (summary["added"] or summary["removed"] or summary["old_duplicate_rows"]):
            kept = {k: old[k] for k in ("digest", "files", "rows", "last_change") if k in old}
            updated = manifest | {"partitions": manifest["partitions"] | {key: entry | kept}}
            write_json(manifest_path, updated)
            manifest.update(updated)
            shutil.rmtree(place)
            return manifest["partitions"][key]
        added, removed = setops.set_difference(before, fresh)
        write_partition(added, place / "added")
        write_partition(removed, place / "removed")
    files = files_of(spark, staged)
    done = entry | {"rows": rows, "files": files, "digest": digest(files), "last_change": {"run_id": run_id, "summary": summary, "transaction": place.name}}
    updated = manifest | {"partitions": manifest.get("partitions", {}) | {key: done}}
    write_json(place / "manifest-before.json", manifest)
    write_json(place / "manifest-after.json", updated)
    journal = {"state": "prepared", "folder": str(folder), "manifest": str(manifest_path), "before": digest(live), "after": done["digest"]}
    write_json(place / "journal.json", journal)
    publish(spark, place, journal)
    manifest.clear()
    manifest.update(updated)
    return done


def publish(spark: SparkSession, place: Path, journal: dict) -> None:
    """Repeatable: every step sees whether it was done."""
    folder, staged, backup = Path(journal["folder"]), place / "new", place / "old"
    if staged.exists():
        if folder.exists():
            os.replace(folder, backup) if not backup.exists() else shutil.rmtree(folder)
        folder.parent.mkdir(parents=True, exist_ok=True)
        os.replace(staged, folder)
    write_json(Path(journal["manifest"]), read_json(place / "manifest-after.json"))
    write_json(place / "journal.json", journal | {"state": "committed"})


def recover(spark: SparkSession, root: Path) -> list[str]:
    """Finish what an interrupted run had journaled, drop what it had not; refuse if live files are neither the old nor the new ones."""
    finished = []
    for place in sorted((root / JOURNALS).glob("*")):
        journal = read_json(place / "journal.json")
        if not journal:
            shutil.rmtree(place)
        elif journal["state"] == "prepared":
            now = digest(files_of(spark, Path(journal["folder"])))
            if now not in (journal["before"], journal["after"], ""):
                raise RecoveryError(f"{journal['folder']} is neither the old nor the new version; look at {place}")
            publish(spark, place, journal)
            finished.append(place.name)
    return finished
