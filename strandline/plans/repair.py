"""Audit of membership intervals and removal of reviewed wrong rows: preview, apply, restore."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import strict_day
from ..operators import intervals, setops
from . import storage
from .contracts import ArchiveError

# The repair's name, the membership columns and the reviewed cases (code, name, entry date).
PATCH_ID = "sw_oil_video_media_20260909_v1"
DATASET = "index_member_all"
COLUMNS = ["l1_code", "l1_name", "l2_code", "l2_name", "l3_code", "l3_name", "ts_code", "name", "in_date", "out_date", "is_new"]
CASES = (("000406.SZ", "石油大明(退市)", "19960628"), ("000817.SZ", "辽河油田(退市)", "19980528"), ("000956.SZ", "中原油气(退市)", "19991110"))
WRONG = ("801760.SI", "传媒", "801767.SI", "数字媒体", "857671.SI", "视频媒体")
RIGHT = ("801960.SI", "石油石化", "801961.SI", "油气开采Ⅱ", "859611.SI", "油气开采Ⅲ")


class PatchError(ArchiveError):
    pass


def audit(rows: DataFrame, start: str, end: str, columns: list[str] | None = None) -> dict:
    """Totals and conflicts between two YYYYMMDD days. Bad flags, codes or reversed intervals are errors."""
    names = columns or [c for c in COLUMNS if c in rows.columns and c not in ("ts_code", "in_date", "out_date", "is_new")]
    begin, stop = strict_day(F.nullif(F.col("in_date"), F.lit(""))), strict_day(F.nullif(F.col("out_date"), F.lit("")))
    dated = rows.withColumns({"__b": begin, "__e": stop})
    unreadable = (F.col("__b").isNull() & (F.coalesce(F.col("in_date"), F.lit("")) != "")) | (F.col("__e").isNull() & (F.coalesce(F.col("out_date"), F.lit("")) != ""))
    counts = dated.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("ts_code").alias("instruments"),
        F.count_if(F.coalesce(F.col("ts_code"), F.lit("")) == "").alias("no_code"),
        F.count_if(~F.coalesce(F.col("is_new").isin("Y", "N"), F.lit(False))).alias("bad_flags"),
        F.count_if(F.col("__e") < F.col("__b")).alias("reversed"),
        F.count_if(unreadable).alias("unreadable"),
    ).first().asDict()
    if bad := {k: counts[k] for k in ("no_code", "bad_flags", "reversed", "unreadable") if counts[k]}:
        raise PatchError(f"membership rows break the rules: {bad}")
    day = lambda s: f"{s[:4]}-{s[4:6]}-{s[6:]}"
    clashes = intervals.conflicts(dated, "ts_code", "__b", "__e", "is_new", names, day(start), day(end)).orderBy("code", "st")
    nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns]).first().asDict()
    return {
        "rows": counts["rows"],
        "instruments": counts["instruments"],
        "null_counts": nulls,
        "duplicate_rows": setops.duplicate_excess(rows).first()["x"],
        "multiple_current": sorted(r["ts_code"] for r in intervals.multiple_current(rows, "ts_code", "is_new").collect()),
        "conflicts": [{"code": r["code"], "start": str(r["st"]), "end": str(r["en"]), "columns": r["differs"].split(",")} for r in clashes.collect()],
    }


def case_frame(spark: SparkSession, path: tuple, cases=CASES) -> DataFrame:
    rows = [(*path, code, name, begin, None, "Y") for code, name, begin in cases]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))


def patch(rows: DataFrame, start: str, end: str, cases=CASES) -> tuple[DataFrame, dict[str, str], list[str]]:
    """(rows without the reviewed wrong ones, status by code, blockers). Other rows and values stay as they are."""
    spark = rows.sparkSession
    wrong, right = case_frame(spark, WRONG, cases), case_frame(spark, RIGHT, cases)
    codes = [c[0] for c in cases]
    count = lambda df: {r["ts_code"]: r["count"] for r in df.groupBy("ts_code").count().collect()}
    mine = rows.where(F.col("ts_code").isin(codes))
    good, bad, every = count(intervals.case_matches(mine, right, "out_date")), count(intervals.case_matches(mine, wrong, "out_date")), count(mine)
    table = spark.createDataFrame([(c, good.get(c, 0), bad.get(c, 0), every.get(c, 0) - good.get(c, 0) - bad.get(c, 0)) for c in codes], "code string, good long, bad long, other long")
    report = {r["code"]: r["status"] for r in table.select("code", intervals.case_status(F.col("good"), F.col("bad"), F.col("other")).alias("status")).collect()}
    remove = [c for c, s in report.items() if s == "remove"]
    blank = lambda df: df.withColumn("out_date", F.nullif(F.col("out_date"), F.lit("")))
    keys = blank(wrong.where(F.col("ts_code").isin(remove))).select(*[F.col(c).alias(f"__{c}") for c in COLUMNS])
    same = [F.nullif(F.col(c), F.lit("")).eqNullSafe(F.col(f"__{c}")) if c == "out_date" else F.col(c).eqNullSafe(F.col(f"__{c}")) for c in COLUMNS]
    clean = rows.join(F.broadcast(keys), same, "left_anti") if remove else rows
    blockers = [f"{c} needs a review" for c, s in report.items() if s == "requires_review"]
    if left := [x for x in audit(clean, start, end)["conflicts"] if x["code"] in codes]:
        blockers.append(f"conflicts stay for {sorted({x['code'] for x in left})}")
    return clean, report, blockers


def apply(spark: SparkSession, root: Path, backup: Path, run_id: str) -> dict:
    """Patch the live membership partition; its folder and manifest are copied to `backup`, which must be new."""
    manifest_path, folder = root / DATASET / "_manifest.json", root / DATASET / "scope=all"
    with storage.archive_lock(root):
        storage.recover(spark, root)
        manifest = storage.read_json(manifest_path)
        entry = manifest["partitions"]["all"]
        rows, report, blockers = patch(storage.read_partition(spark, folder), entry["query"]["start_date"], entry["query"]["end_date"])
        if blockers:
            raise PatchError("; ".join(blockers))
        if "remove" not in report.values():
            return report
        backup.mkdir(parents=True, exist_ok=False)
        shutil.copytree(folder, backup / "data")
        shutil.copy2(manifest_path, backup / "_manifest.json")
        done = storage.commit_partition(root, folder, manifest_path, manifest, "all", rows, {k: v for k, v in entry.items() if k not in ("files", "digest", "rows")} | {"industry_patch_id": PATCH_ID}, run_id)
        storage.write_json(backup / "applied.json", {"before": entry["digest"], "after": done["digest"]})
        return report


def restore(spark: SparkSession, root: Path, backup: Path) -> None:
    """Undo apply(): only if the live files are still those that it published and the backup is whole."""
    folder, applied = root / DATASET / "scope=all", storage.read_json(backup / "applied.json")
    with storage.archive_lock(root):
        if storage.digest(storage.files_of(spark, folder)) != applied.get("after") or storage.digest(storage.files_of(spark, backup / "data")) != applied.get("before"):
            raise PatchError("live or saved files are not those of the repair")
        shutil.rmtree(folder)
        shutil.copytree(backup / "data", folder)
        storage.write_json(root / DATASET / "_manifest.json", storage.read_json(backup / "_manifest.json"))
