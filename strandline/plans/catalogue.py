"""Queries of the archive operators over the test tables, with their DuckDB SQL.

The test tables stand in for the archive's: orders for quarterly rows (o_orderdate announces, the end of
its quarter is the period, o_orderkey % 12 + 1 the report type), events for daily rows, orders by
customer for membership intervals, an edited copy of orders for a refreshed snapshot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numeric
from ..operators import intervals, paging, setops, windows
from . import planning

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

START, STOP = "1995-01-01", "1996-12-31"
FIN = """fin AS (SELECT CAST(o_custkey AS VARCHAR) AS ts_code, strftime(o_orderdate, '%Y%m%d') AS ann_date,
  strftime(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH), '%Y%m%d') AS end_date,
  CAST(o_orderkey % 12 + 1 AS INTEGER) AS report_type, o_totalprice AS value, o_orderkey AS k FROM orders)"""
MEMBERS = """m AS (SELECT CAST(o_custkey AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS e,
  CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS flag, o_orderpriority AS l1, o_orderstatus AS l2 FROM orders)"""
OLD = "old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)"
NEW = """new AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0)"""
DIRTY = "t AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE l_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN 'x' || CAST(l_linenumber AS VARCHAR) WHEN 3 THEN '1.0d' WHEN 4 THEN ' ' || CAST(l_linenumber AS VARCHAR) || '.25 ' ELSE CAST(l_linenumber AS VARCHAR) END AS s FROM lineitem)"
NUM = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fin(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("ts_code"), dates.as_text(day).alias("ann_date"), dates.as_text(dates.quarter_end(day)).alias("end_date"), (F.col("o_orderkey") % 12 + 1).cast("int").alias("report_type"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("k")
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    flag = F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("code"), day.alias("b"), F.date_add(day, (F.col("o_orderkey") % 400).cast("int")).alias("e"), flag.alias("flag"), F.col("o_orderpriority").alias("l1"), F.col("o_orderstatus").alias("l2"))


def old_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kept = old.where("o_orderkey % 7 <> 0")
    edited = kept.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return old, edited.unionByName(kept.where("o_orderkey % 11 = 0"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber").cast("string")
    m = F.col("l_orderkey") % 7
    text = F.when(m == 0, "").when(m == 1, "  ").when(m == 2, F.concat(F.lit("x"), n)).when(m == 3, "1.0d").when(m == 4, F.concat(F.lit(" "), n, F.lit(".25 "))).otherwise(n)
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), text.alias("s"))


# Scans


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("SELECT o_orderdate FROM orders")
def column_pruned_scan(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderdate")


@query("SELECT count(*) AS n FROM orders")
def directory_count(spark, sf_dir):
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{sf_dir}/orders.parquet").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'lineitem.parquet' AS file, count(*) AS n FROM lineitem")
def per_file_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))


# Paging

PAGED = """o AS (SELECT o_orderkey AS k, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders WHERE o_orderstatus = 'F'),
z AS (SELECT CAST(greatest(0, ceil((max(n) - 999) / 800.0)) AS BIGINT) AS last FROM o),
pg AS (SELECT p.page, o.* FROM o, generate_series(0, 100000) p(page), z WHERE p.page <= z.last AND o.rn >= p.page * 800 AND o.rn < p.page * 800 + 1000)"""


def paged(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), "o_custkey")
    return paging.pages(rows, "k", 1000, 200)


@query(f"WITH {PAGED}, u AS (SELECT count(*) AS raw, count(DISTINCT k) AS uniq, count(DISTINCT (page, k)) AS pu, max(page) + 1 AS pages FROM pg) SELECT CAST(pages AS BIGINT) AS pages, raw, uniq, pu - uniq AS cross_page_duplicates, raw - uniq AS removed FROM u")
def overlap_pagination(spark, sf_dir):
    return paging.page_statistics(paged(spark, sf_dir), ["k", "o_custkey"])


@query(f"WITH {PAGED} SELECT CAST(page AS INTEGER) AS page, count(*) AS n, sha256(string_agg(md5(k || '|' || o_custkey), ',' ORDER BY rn)) AS fp FROM pg GROUP BY page")
def page_fingerprint(spark, sf_dir):
    return paging.page_fingerprints(paged(spark, sf_dir), ["k", "o_custkey"])


@query("SELECT count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def page_overlap_count(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return setops.intersect_count(rows.where("o_orderstatus = 'F'").select("o_custkey"), rows.where("o_orderstatus = 'O'").select("o_custkey"))


# Partition readers and validation


@query(f"WITH {FIN} SELECT * FROM fin WHERE end_date = '19960331'")
def period_slice(spark, sf_dir):
    return fin(spark, sf_dir).where("end_date = '19960331'")


@query("WITH c AS (SELECT l_linenumber AS rt, count(*) AS n FROM lineitem WHERE l_linenumber BETWEEN 1 AND 12 GROUP BY 1) SELECT CAST(r.rt AS INTEGER) AS rt, coalesce(c.n, 0) AS n FROM generate_series(1, 12) r(rt) LEFT JOIN c ON c.rt = r.rt")
def statement_union(spark, sf_dir):
    return windows.statement_stats(table(spark, sf_dir, "lineitem"), "l_linenumber")


@query(f"WITH {FIN} SELECT * FROM fin WHERE ann_date BETWEEN '19960101' AND '19960630'")
def event_window_slice(spark, sf_dir):
    return fin(spark, sf_dir).where(windows.inside("ann_date", "19960101", "19960630"))


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS trade_date, value FROM events WHERE strftime(ts, '%Y%m%d') = '20240105'")
def daily_slice(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", dates.as_text(F.col("ts").cast("date")).alias("trade_date"), "value", "ts")
    return rows.where("ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-06'").drop("ts")


@query("""WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS b,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE strftime(o_orderdate + INTERVAL 90 DAY, '%Y%m%d') END AS e FROM orders)
SELECT k FROM t WHERE (b IS NULL OR b <= '19970331') AND (e IS NULL OR e = '' OR e >= '19960401')""")
def interval_overlap_filter(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 5 != 0, dates.as_text(day)).alias("b"), F.when(k % 4 == 1, "").when(k % 4 != 0, dates.as_text(F.date_add(day, 90))).alias("e"))
    return rows.where(intervals.overlaps(F.col("b"), F.col("e"), "19960401", "19970331")).select("k")


@query(f"WITH {FIN} SELECT DISTINCT end_date AS p FROM fin WHERE ann_date BETWEEN '19951215' AND '19960415' AND end_date >= '19951231'")
def discover_periods(spark, sf_dir):
    return windows.discover_periods(fin(spark, sf_dir), "ann_date", "end_date", "19951215", "19960415", "19951231")


@query(f"WITH {FIN} SELECT k, report_type, end_date FROM fin WHERE end_date BETWEEN '19960101' AND '19961231' AND end_date IS DISTINCT FROM '19960331'")
def period_violations(spark, sf_dir):
    rows = fin(spark, sf_dir).where("end_date between '19960101' and '19961231'").select("k", "report_type", "end_date")
    return windows.key_violations(rows, "end_date", "19960331")


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS trade_date FROM events WHERE strftime(ts, '%Y%m%d') <> '20240105'")
def daily_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", dates.as_text(F.col("ts").cast("date")).alias("trade_date"))
    return windows.key_violations(rows, "trade_date", "20240105")


@query(f"WITH {FIN}, t AS (SELECT k, CASE WHEN k % 9 = 0 THEN NULL ELSE ann_date END AS ann_date FROM fin) SELECT k, ann_date FROM t WHERE ann_date IS NULL OR ann_date NOT BETWEEN '19950101' AND '19971231'")
def event_violations(spark, sf_dir):
    rows = fin(spark, sf_dir).select("k", F.when(F.col("k") % 9 != 0, F.col("ann_date")).alias("ann_date"))
    return windows.window_violations(rows, "ann_date", "19950101", "19971231")


@query(f"WITH {FIN}, t AS (SELECT k, CASE WHEN k % 13 = 0 THEN NULL ELSE report_type END AS report_type FROM fin) SELECT k, report_type FROM t WHERE report_type IS DISTINCT FROM 1")
def tag_violations(spark, sf_dir):
    rows = fin(spark, sf_dir).select("k", F.when(F.col("k") % 13 != 0, F.col("report_type")).alias("report_type"))
    return windows.tag_violations(rows, "report_type", 1)


@query(f"""WITH {DIRTY} SELECT id, CAST(CASE WHEN regexp_matches(trim(s), {NUM}) THEN trim(s) END AS DOUBLE) AS d,
  NOT regexp_matches(trim(s), {NUM}) AND trim(s) <> '' AS bad FROM t""")
def coerce_numeric(spark, sf_dir):
    return dirty(spark, sf_dir).select("id", numeric.to_double(F.col("s")).alias("d"), numeric.bad_double(F.col("s")).alias("bad"))


@query(f"""WITH {DIRTY} SELECT id, CAST(CASE WHEN regexp_matches(trim(s), '^[0-9]+$') THEN trim(s) END AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS absent FROM t""")
def normalize_projection(spark, sf_dir):
    return dirty(spark, sf_dir).select("id", numeric.to_long(F.col("s")).alias("n"), F.lit(None).cast("double").alias("absent"))


STRICT = "SELECT s, CASE WHEN regexp_matches(s, '^[0-9]{8}$') THEN CAST(try_strptime(s, '%Y%m%d') AS DATE) END AS d FROM"


@query(f"""WITH s AS (SELECT CASE o_orderkey % 6 WHEN 0 THEN '20230229' WHEN 1 THEN '20240229' WHEN 2 THEN '2024011' WHEN 3 THEN '2024-1-1' WHEN 4 THEN '20241301' ELSE strftime(o_orderdate, '%Y%m%d') END AS s FROM orders) {STRICT} s""")
def strict_dates(spark, sf_dir):
    m, day = F.col("o_orderkey") % 6, dates.as_text(F.col("o_orderdate").cast("date"))
    text = F.when(m == 0, "20230229").when(m == 1, "20240229").when(m == 2, "2024011").when(m == 3, "2024-1-1").when(m == 4, "20241301").otherwise(day)
    return table(spark, sf_dir, "orders").select(text.alias("s")).withColumn("d", dates.strict_day(F.col("s")))


@query(f"WITH {FIN} SELECT DISTINCT end_date AS p FROM fin WHERE strptime(end_date, '%Y%m%d') <= DATE '1998-06-30' - 120")
def historical_periods(spark, sf_dir):
    return fin(spark, sf_dir).select(F.col("end_date").alias("p")).distinct().where(dates.is_historical(F.col("p"), "1998-06-30"))


@query(f"WITH {FIN} SELECT end_date AS period, count(*) AS n, count(*) FILTER (WHERE ann_date = end_date) AS at_end FROM fin GROUP BY end_date")
def quarter_bucket(spark, sf_dir):
    return fin(spark, sf_dir).groupBy(F.col("end_date").alias("period")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ann_date") == F.col("end_date")).alias("at_end"))


# Sets and multisets


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@query(f"WITH {OLD}, {NEW} SELECT 'added' AS side, count(*) AS n FROM (SELECT * FROM new EXCEPT SELECT * FROM old) UNION ALL SELECT 'removed', count(*) FROM (SELECT * FROM old EXCEPT SELECT * FROM new)")
def set_diff(spark, sf_dir):
    return setops.set_diff_counts(*old_new(spark, sf_dir))


@query(f"""WITH {OLD}, {NEW} SELECT (SELECT count(*) FROM old) AS old_rows, (SELECT count(*) FROM new) AS new_rows,
  (SELECT count(*) FROM old) - (SELECT count(*) FROM (SELECT DISTINCT * FROM old)) AS old_duplicate_rows, (SELECT count(*) FROM new) - (SELECT count(*) FROM (SELECT DISTINCT * FROM new)) AS new_duplicate_rows,
  (SELECT count(*) FROM (SELECT * FROM new EXCEPT SELECT * FROM old)) AS added, (SELECT count(*) FROM (SELECT * FROM old EXCEPT SELECT * FROM new)) AS removed""")
def change_summary(spark, sf_dir):
    return setops.change_summary(*old_new(spark, sf_dir))


@query("""WITH s AS (SELECT l_suppkey, l_linenumber, l_returnflag, l_quantity FROM lineitem), c AS (SELECT l_suppkey, l_linenumber, l_returnflag, l_quantity + CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS l_quantity FROM lineitem WHERE l_orderkey % 97 <> 0)
SELECT CAST(sum(greatest(g, 0)) AS BIGINT) AS missing_rows, CAST(sum(greatest(-g, 0)) AS BIGINT) AS extra_rows FROM (SELECT sum(d) AS g FROM (SELECT *, 1 AS d FROM s UNION ALL SELECT *, -1 FROM c) GROUP BY l_suppkey, l_linenumber, l_returnflag, l_quantity)""")
def multiset_diff(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    source = rows.select("l_suppkey", "l_linenumber", "l_returnflag", "l_quantity")
    copy = rows.where("l_orderkey % 97 <> 0").select("l_suppkey", "l_linenumber", "l_returnflag", (F.col("l_quantity") + F.when(F.col("l_orderkey") % 50 == 0, 1).otherwise(0)).alias("l_quantity"))
    return setops.multiset_difference(source, copy)


@query("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem)) AS x FROM lineitem")
def duplicate_excess(spark, sf_dir):
    return setops.duplicate_excess(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"))


@query("""SELECT count(*) FILTER (WHERE o_custkey IS NULL) AS null_o_custkey, count(*) FILTER (WHERE s IS NULL) AS null_s, count(DISTINCT o_custkey) AS instruments
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE o_orderstatus END AS s FROM orders)""")
def null_counts(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    return setops.null_counts(table(spark, sf_dir, "orders").select("o_custkey", F.when(k == 1, "").when(k == 2, F.col("o_orderstatus")).alias("s")), "o_custkey")


@query(f"""WITH {FIN}, o AS (SELECT ts_code, ann_date, end_date, value FROM fin), w AS (SELECT ts_code, ann_date, end_date, value + 1 AS value FROM o WHERE ann_date BETWEEN '19960101' AND '19960630' AND CAST(ts_code AS INTEGER) % 3 <> 0)
SELECT DISTINCT * FROM (SELECT * FROM o WHERE NOT coalesce(ann_date BETWEEN '19960101' AND '19960630', false) UNION ALL SELECT * FROM w)""")
def window_replace(spark, sf_dir):
    old = fin(spark, sf_dir).select("ts_code", "ann_date", "end_date", "value")
    new = old.where(windows.inside("ann_date", "19960101", "19960630")).where("cast(ts_code as int) % 3 <> 0").withColumn("value", F.col("value") + 1)
    return windows.replace_window(old, new, "ann_date", "19960101", "19960630")


@query("""WITH c AS (SELECT o_orderpriority AS part, count(DISTINCT o_custkey) AS old_rows, count(DISTINCT CASE WHEN o_orderstatus = 'F' OR (o_orderpriority = '1-URGENT') THEN o_custkey END) FILTER (WHERE o_orderpriority <> '2-HIGH') AS new_rows FROM orders GROUP BY 1)
SELECT part, old_rows, new_rows, CASE WHEN (old_rows > 0 AND new_rows = 0) OR new_rows < 0.5 * old_rows THEN 'refuse' ELSE 'pass' END AS verdict FROM c""")
def overwrite_guard(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    new = F.when((F.col("o_orderpriority") != "2-HIGH") & ((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")), F.col("o_custkey"))
    counts = rows.groupBy(F.col("o_orderpriority").alias("part")).agg(F.count_distinct("o_custkey").alias("old_rows"), F.count_distinct(new).alias("new_rows"))
    return counts.withColumn("verdict", windows.guard_verdict(F.col("old_rows"), F.col("new_rows")))


# Intervals


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) > 1")
def multiple_current(spark, sf_dir):
    return intervals.multiple_current(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "O")


@query(f"""WITH {MEMBERS}, r AS (SELECT code, b AS key, flag, l1, l2, greatest(b, DATE '{START}') AS b, least(e, DATE '{STOP}') AS e FROM m WHERE greatest(b, DATE '{START}') <= least(e, DATE '{STOP}')),
p AS (SELECT code, b AS p FROM r UNION SELECT code, e + 1 FROM r), s AS (SELECT code, p AS st, lead(p) OVER (PARTITION BY code ORDER BY p) - 1 AS en FROM p),
a AS (SELECT s.code, s.st, s.en, r.key, r.flag, r.l1, r.l2, count(*) OVER w AS n, rank() OVER (PARTITION BY s.code, s.st ORDER BY r.key DESC, r.flag DESC) AS rk FROM s JOIN r ON r.code = s.code AND r.b <= s.st AND s.en <= r.e WHERE s.en IS NOT NULL WINDOW w AS (PARTITION BY s.code, s.st)),
t AS (SELECT code, st, en, count(*) AS n_tied, count(DISTINCT l1) AS d1, count(DISTINCT l2) AS d2 FROM a WHERE n > 1 AND rk = 1 GROUP BY 1, 2, 3)
SELECT code, st, CAST(en AS DATE) AS en, n_tied, concat_ws(',', CASE WHEN d1 > 1 THEN 'l1' END, CASE WHEN d2 > 1 THEN 'l2' END) AS differs FROM t WHERE n_tied > 1 AND (d1 > 1 OR d2 > 1)""")
def interval_conflicts(spark, sf_dir):
    return intervals.conflicts(members(spark, sf_dir), "code", "b", "e", "flag", ["l1", "l2"], START, STOP)


CASES = [("5", "O", "1-URGENT", ""), ("7", "F", "2-HIGH", None), ("11", "O", "3-MEDIUM", "x"), ("13", "F", "1-URGENT", "")]
CASE_SQL = "k(c, s, p, o) AS (VALUES ('5', 'O', '1-URGENT', NULL), ('7', 'F', '2-HIGH', NULL), ('11', 'O', '3-MEDIUM', 'x'), ('13', 'F', '1-URGENT', NULL))"


@query(f"WITH {CASE_SQL}, d AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s, o_orderpriority AS p, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'x' END AS o FROM orders) SELECT d.* FROM d WHERE EXISTS (SELECT 1 FROM k WHERE k.c = d.c AND k.s = d.s AND k.p = d.p AND k.o IS NOT DISTINCT FROM nullif(d.o, ''))")
def reviewed_case_match(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"), F.when(k == 0, "").when(k == 2, "x").alias("o"))
    return intervals.case_matches(rows, spark.createDataFrame(CASES, "c string, s string, p string, o string"), "o")


@query("""WITH c AS (SELECT c_custkey AS code, count(o_orderkey) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS good, count(o_orderkey) FILTER (WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS bad,
  count(o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus NOT IN ('F', 'O')) AS other FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT code, good, bad, other, CASE WHEN good + bad + other = 0 THEN 'not_present' WHEN good <> 1 OR bad > 1 OR other > 0 THEN 'requires_review' WHEN bad = 1 THEN 'remove' ELSE 'already_clean' END AS status FROM c""")
def reviewed_case_status(spark, sf_dir):
    urgent, status = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(urgent & (status == "F")).alias("good"), F.count_if(urgent & (status == "O")).alias("bad"), F.count_if(urgent & ~status.isin("F", "O")).alias("other"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code")).join(per, F.col("code") == F.col("o_custkey"), "left").select("code", zero("good"), zero("bad"), zero("other"))
    return rows.withColumn("status", intervals.case_status(F.col("good"), F.col("bad"), F.col("other")))


# Keys and planning


@query("SELECT strftime(last_day(d + INTERVAL 2 MONTH), '%Y%m%d') AS p FROM generate_series(DATE '2016-07-01', DATE '2026-07-01', INTERVAL 3 MONTH) g(d) WHERE last_day(d + INTERVAL 2 MONTH) BETWEEN DATE '2016-07-20' AND DATE '2026-07-20'")
def quarter_ends(spark, sf_dir):
    return dates.quarter_end_keys(spark, "2016-07-20", "2026-07-20")


@query("SELECT strftime(d, '%Y%m%d') AS p FROM generate_series(DATE '2024-01-01', DATE '2024-03-05', INTERVAL 1 DAY) g(d)")
def calendar_dates(spark, sf_dir):
    return dates.calendar_keys(spark, "2024-01-01", "2024-03-05")


@query("SELECT CAST(y AS VARCHAR) AS yr, strftime(greatest(make_date(CAST(y AS INTEGER), 1, 1), DATE '2016-07-20'), '%Y%m%d') AS lo, strftime(least(make_date(CAST(y AS INTEGER), 12, 31), DATE '2026-03-04'), '%Y%m%d') AS hi FROM generate_series(2016, 2026) g(y)")
def event_year_ranges(spark, sf_dir):
    return dates.year_range_keys(spark, "2016-07-20", "2026-03-04")


CALENDAR = "SELECT strftime(d, '%Y%m%d') AS p FROM generate_series(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY) g(d)"


def event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(dates.as_text(F.col("ts").cast("date")).alias("p")).distinct()


@query(f"{CALENDAR} WHERE p NOT IN (SELECT strftime(ts, '%Y%m%d') FROM events)")
def missing_partitions(spark, sf_dir):
    return planning.missing_keys(dates.calendar_keys(spark, "2023-12-20", "2024-02-10"), event_days(spark, sf_dir))


@query(f"WITH c AS ({CALENDAR}) SELECT p FROM c WHERE p NOT IN (SELECT strftime(ts, '%Y%m%d') FROM events) UNION SELECT p FROM (SELECT p FROM c ORDER BY p DESC LIMIT 7)")
def update_targets_daily(spark, sf_dir):
    days = dates.calendar_keys(spark, "2023-12-20", "2024-02-10")
    return planning.missing_keys(days, event_days(spark, sf_dir)).unionByName(days.orderBy(F.desc("p")).limit(7)).distinct()


@query("SELECT DISTINCT strftime(ts, '%Y%m%d') AS p FROM events ORDER BY p DESC LIMIT 7")
def recent_keys(spark, sf_dir):
    return event_days(spark, sf_dir).orderBy(F.desc("p")).limit(7)


QUARTERS = "SELECT strftime(last_day(d + INTERVAL 2 MONTH), '%Y%m%d') AS p FROM generate_series(DATE '1994-01-01', DATE '2002-10-01', INTERVAL 3 MONTH) g(d)"


@query(f"""WITH {FIN}, q AS ({QUARTERS}), e AS (SELECT DISTINCT end_date AS p FROM fin WHERE end_date <> '19970331'), d AS (SELECT DISTINCT end_date AS p FROM fin WHERE ann_date BETWEEN '19960601' AND '19960730')
SELECT p FROM q WHERE p NOT IN (SELECT p FROM e) UNION SELECT p FROM (SELECT p FROM q ORDER BY p DESC LIMIT 8) UNION SELECT p FROM d""")
def update_targets_period(spark, sf_dir):
    quarters = dates.quarter_end_keys(spark, "1994-01-01", "2002-12-31")
    rows = fin(spark, sf_dir)
    present = rows.where("end_date <> '19970331'").select(F.col("end_date").alias("p")).distinct()
    found = windows.discover_periods(rows, "ann_date", "end_date", "19960601", "19960730", "00000000")
    return planning.missing_keys(quarters, present).unionByName(quarters.orderBy(F.desc("p")).limit(8)).unionByName(found).distinct()


@query(f"""WITH {FIN}, y AS (SELECT CAST(v AS VARCHAR) AS yr, strftime(greatest(make_date(CAST(v AS INTEGER), 1, 1), DATE '1994-03-05'), '%Y%m%d') AS lo, strftime(least(make_date(CAST(v AS INTEGER), 12, 31), DATE '2002-06-30'), '%Y%m%d') AS hi FROM generate_series(1994, 2002) g(v)), e AS (SELECT DISTINCT substr(ann_date, 1, 4) AS yr FROM fin)
SELECT y.yr, CASE WHEN e.yr IS NULL THEN lo ELSE greatest(lo, '20010620') END AS lo, hi FROM y LEFT JOIN e ON e.yr = y.yr WHERE e.yr IS NULL OR hi >= '20010620'""")
def update_targets_event(spark, sf_dir):
    present = fin(spark, sf_dir).select(F.substring("ann_date", 1, 4).alias("e")).distinct()
    years = dates.year_range_keys(spark, "1994-03-05", "2002-06-30").join(present, F.col("yr") == F.col("e"), "left").where("e is null or hi >= '20010620'")
    return years.select("yr", F.when(F.col("e").isNull(), F.col("lo")).otherwise(F.greatest("lo", F.lit("20010620"))).alias("lo"), "hi")


@query(f"WITH {FIN}, y AS (SELECT DISTINCT substr(ann_date, 1, 4) AS p FROM fin) SELECT p FROM y ORDER BY p <= '1996', p LIMIT 4")
def history_rotation(spark, sf_dir):
    return planning.rotated(fin(spark, sf_dir).select(F.substring("ann_date", 1, 4).alias("p")).distinct(), "1996", 4)


@query(f"WITH {FIN}, x AS (SELECT max(ann_date) AS through FROM fin) SELECT strftime(least(greatest(DATE '1990-01-01', CAST(strptime(least(through, '20000101'), '%Y%m%d') AS DATE) - 6), DATE '1999-11-30'), '%Y%m%d') AS start FROM x")
def update_window_start(spark, sf_dir):
    through = F.to_date(F.least("through", F.lit("20000101")), dates.FORMAT)
    start = F.least(F.greatest(F.lit("1990-01-01").cast("date"), F.date_sub(through, 6)), F.lit("1999-11-30").cast("date"))
    return fin(spark, sf_dir).agg(F.max("ann_date").alias("through")).select(dates.as_text(start).alias("start"))


@query(f"""WITH {FIN}, d AS (SELECT DISTINCT CASE report_type WHEN 1 THEN 'income' WHEN 2 THEN 'cashflow' ELSE 'balancesheet' END AS ds, end_date AS p FROM fin WHERE report_type <= 3),
t(source, receiver) AS (VALUES ('income', 'balancesheet'), ('income', 'fina_indicator'), ('cashflow', 'balancesheet'), ('cashflow', 'fina_indicator'), ('balancesheet', 'fina_indicator'))
SELECT ds, p FROM d UNION SELECT receiver, p FROM d JOIN t ON ds = source""")
def trigger_propagation(spark, sf_dir):
    name = F.when(F.col("report_type") == 1, "income").when(F.col("report_type") == 2, "cashflow").otherwise("balancesheet")
    found = fin(spark, sf_dir).where("report_type <= 3").select(name.alias("ds"), F.col("end_date").alias("p")).distinct()
    edges = [(s, r) for s, receivers in planning.TRIGGERS.items() for r in receivers]
    return planning.propagate(found, spark.createDataFrame(edges, "source string, receiver string"))


@query(f"WITH {FIN}, r AS (SELECT report_type, min(ann_date) AS lo, max(ann_date) AS hi FROM fin GROUP BY 1) SELECT report_type, least(lo, '19960101') AS lo, greatest(hi, '20000101') AS hi FROM r")
def range_union(spark, sf_dir):
    rows = fin(spark, sf_dir).groupBy("report_type").agg(F.min("ann_date").alias("lo"), F.max("ann_date").alias("hi"))
    return rows.select("report_type", F.least("lo", F.lit("19960101")).alias("lo"), F.greatest("hi", F.lit("20000101")).alias("hi"))


@query(f"""WITH {FIN}, e AS (SELECT end_date, report_type, count(*) FILTER (WHERE value > 100000) AS rows FROM fin GROUP BY 1, 2) SELECT report_type, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS partitions, count(*) FILTER (WHERE rows = 0) AS empty_partitions FROM e GROUP BY 1""")
def verify_rollup(spark, sf_dir):
    entries = fin(spark, sf_dir).groupBy("end_date", "report_type").agg(F.count_if(F.col("value") > 100000).alias("rows"))
    return entries.groupBy("report_type").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"), F.count_if(F.col("rows") == 0).alias("empty_partitions"))
