"""Control plane with a source in memory: contracts, paging, commits, recovery, runs, verification, repair, mirror."""

import datetime as dt
import json
import urllib.error

import pytest

from strandline.cli import main
from strandline.functions.dates import DateError, calendar_days, day_text, parse_day, quarter_ends, year_ranges
from strandline.operators import intervals, paging, setops, windows
from strandline.operators.normalise import normalise
from strandline.operators.ordinal import with_ordinal
from strandline.plans import planning, repair, storage
from strandline.plans.contracts import DATASETS, ArchiveError, ConfigurationError, Field, OverwriteGuardError, SourceSchemaError, parse_fields, schema_hash, select_datasets
from strandline.plans.pipeline import Archive
from strandline.sources import mirror
from strandline.sources.http import Client, parse_answer, read_all

D = parse_day


def doc(columns):
    return "# api\n\n## 输入参数\n\n| 名称 | 类型 |\n|--|--|\n| x | int |\n\n### 输出参数\n\n| 名称 | 类型 | 描述 |\n| --- | --- | --- |\n" + "".join(f"| `{n}` | {t} | d |\n" for n, t in columns) + "\n## 后\n| y | int |\n"


def test_contract():
    fields = parse_fields(doc([("ts_code", "str"), ("value", "float"), ("n", "int"), ("p", "**point**")]))
    assert [(f.name, f.kind) for f in fields] == [("ts_code", "string"), ("value", "double"), ("n", "bigint"), ("p", "bigint")]
    assert schema_hash(fields) != schema_hash(fields[::-1])
    for bad in ("# nothing", doc([]), doc([("a", "int"), ("a", "int")])):
        with pytest.raises(ConfigurationError):
            parse_fields(bad)
    assert [d.name for d in select_datasets("income_vip,income,daily_basic")] == ["income", "daily_basic"]
    with pytest.raises(ConfigurationError):
        select_datasets("nothing")


def test_dates():
    ends = quarter_ends(D("20160720"), D("20260720"))
    assert len(ends) == 40 and ends[0] == "20160930" and ends[-1] == "20260630"
    assert year_ranges(D("20160720"), D("20170304")) == [("2016", "20160720", "20161231"), ("2017", "20170101", "20170304")]
    assert calendar_days(D("20240228"), D("20240301")) == ["20240228", "20240229", "20240301"]
    for bad in ("2024-01-01", "20240230", "2024011", "２０２４0101"):
        with pytest.raises(DateError):
            parse_day(bad)


def test_normalise(spark):
    fields = [Field("ts_code", "str"), Field("value", "float"), Field("n", "int"), Field("extra", "float")]
    rows = spark.createDataFrame([("a", "1.25", " 9007199254740993 ", "z"), ("b", " ", "1e3", "z")], "ts_code string, value string, n string, other string")
    out = normalise(rows, fields, frozenset({"extra"}))
    assert [tuple(r) for r in out.collect()] == [("a", 1.25, 9007199254740993, None), ("b", None, 1000, None)] and out.columns == [f.name for f in fields]
    with pytest.raises(SourceSchemaError):
        normalise(rows, fields)
    assert normalise(rows.limit(0), fields).count() == 0
    for bad in ("1.5", "nan", "1.0d", "x"):
        with pytest.raises(SourceSchemaError):
            normalise(spark.createDataFrame([(bad,)], "n string"), [Field("n", "int")])


def paged(rows):
    def answer(api, fields, params):
        return ["code"], [[r] for r in rows[params["offset"] : params["offset"] + params["limit"]]]

    return Client(override=answer, interval=0)


def test_paging(spark):
    df, stats = read_all(spark, paged(list("AABCD")), "x", ["code"], {}, 3, 1)
    assert sorted(r[0] for r in df.collect()) == list("ABCD")
    assert stats == {"pages": 3, "raw_rows": 7, "last_page_rows": 1, "cross_page_duplicates": 2, "duplicates_removed": 3}
    assert paging.page_count(5, 3, 1) == 3 and paging.page_count(510, 250, 200) == 7 and paging.page_count(0, 3, 1) == 1
    _, stats = read_all(spark, paged(list(range(510))), "x", ["code"], {}, 250, 200)
    assert stats["pages"] == 7
    with pytest.raises(SourceSchemaError):
        list(Client(override=lambda *a: (["c"], [[1], [2]]), interval=0).all_pages("x", "c", {}, 2, 1))
    with pytest.raises(SourceSchemaError):
        list(Client(override=lambda *a: (["c"], [[1]] * 3), interval=0).all_pages("x", "c", {}, 2, 1))


def test_ordinal_over_buckets(spark):
    df = spark.range(0, 1000).selectExpr("id * 7 % 1009 as k")
    found = [r["ordinal"] for r in with_ordinal(df, "k", bucket_rows=64).orderBy("k").collect()]
    assert found == list(range(1000))


def test_transport():
    good = json.dumps({"code": 0, "data": {"fields": ["a"], "items": [[1]]}}).encode()
    assert parse_answer(good, "a") == (["a"], [[1]])
    assert parse_answer(b'{"code": 0, "data": {"fields": [], "items": []}}', "a,b") == (["a", "b"], [])
    for bad in (b"x", b'{"code": true}', b'{"code": 0}', b'{"code": 0, "data": {"fields": ["a"], "items": [[1, 2]]}}', b'{"code": 0, "data": {"fields": [], "items": [[1]]}}'):
        with pytest.raises(SourceSchemaError):
            parse_answer(bad, "a")

    def failing(errors):
        left = list(errors)

        def answer(*a):
            if left:
                raise left.pop(0)
            return ["a"], []

        return answer

    http = lambda code, **h: urllib.error.HTTPError("u", code, "token-1 no", h, None)
    waits = []
    client = Client(token="token-1", override=failing([http(503), http(429, **{"Retry-After": "17"}), OSError("x")]), interval=0, sleep=waits.append)
    assert client.page("x", "a", {}) == (["a"], []) and len(waits) == 3 and 17 in waits
    for errors in ([http(404)], [RuntimeError("抱歉,权限 不足")], [http(429, **{"Retry-After": "100"})], [OSError("token-1")] * 9):
        with pytest.raises(ArchiveError) as e:
            Client(token="token-1", override=failing(errors), interval=0, sleep=waits.append).page("x", "a", {})
        assert "token-1" not in str(e.value)


def test_sets(spark):
    row = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    s = setops.change_summary(row(1, 2), row(9, 2, 3)).first()
    assert (s["old_rows"], s["new_rows"], s["added"], s["removed"]) == (2, 3, 2, 1)
    assert setops.change_summary(row(1, 1, None, None), row(1, None)).first()["old_duplicate_rows"] == 2
    added, removed = setops.set_difference(row(1), row(1).selectExpr("cast(v as int) v"))
    assert added.count() == removed.count() == 1
    d = setops.multiset_difference(row(1, 1, 2), row(1, 2, 2)).first()
    assert (d["missing_rows"], d["extra_rows"]) == (1, 1)


def test_overlap_and_guard(spark):
    data = [("20160101", "20160719"), ("20160101", "20160720"), (None, ""), ("20260721", None), ("20260720", "20260720")]
    df = spark.createDataFrame(data, "b string, e string")
    assert [r[0] for r in df.select(intervals.overlaps(df.b, df.e, "20160720", "20260720")).collect()] == [False, True, True, False, True]
    assert [windows.may_overwrite(*x) for x in ((5, 0), (10, 4), (10, 5), (0, 0))] == [False, False, True, True]
    assert windows.may_overwrite(10, 1, allow_shrink=True)


def test_planners():
    spec = DATASETS["income"]
    manifest = {"partitions": {p: {} for p in quarter_ends(D("20200101"), D("20211231")) if p != "20200630"}, "update_state": {"history_cursor": "20200930"}}
    targets = planning.update_targets(spec, manifest, D("20200101"), D("20211231"), quarters=2, discovered=["20200331"])
    assert [t[0] for t in targets] == ["20200331", "20200630", "20210930", "20211231"]
    assert planning.history_keys(manifest, D("20200101"), D("20211231"), 2, 2) == ["20201231", "20210331"]
    assert planning.rotation(["a", "b", "c"], "b", 2) == ["c", "a"]
    event = planning.update_targets(DATASETS["stk_holdernumber"], {"partitions": {"2020": {"x": 1}}, "range_end": "20201229"}, D("20200101"), D("20210110"), event_days=3)
    assert event == [("2020", {"start_date": "20201227", "end_date": "20201231"}), ("2021", {"start_date": "20210101", "end_date": "20210110"})]
    assert planning.owed_quarters({"income": {"q"}, "balancesheet": set(), "fina_indicator": set()}, {}) == {"income": {"q"}, "balancesheet": {"q"}, "fina_indicator": {"q"}}


def test_commit_and_recovery(spark, tmp_path, monkeypatch):
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    folder, path = tmp_path / "d" / "period=1", tmp_path / "d" / "_manifest.json"
    manifest = {"partitions": {}}
    commit = lambda df, run: storage.commit_partition(tmp_path, folder, path, manifest, "1", df, {"query": {}}, run)
    first = commit(frame(1, 2, 2), "r1")
    assert first["rows"] == 2
    same = commit(frame(2, 1), "r2")
    assert same["digest"] == first["digest"] and same["last_change"]["run_id"] == "r1"
    before = dict(manifest)
    real = storage.publish
    monkeypatch.setattr(storage, "publish", lambda *a: (_ for _ in ()).throw(OSError("power cut")))
    with pytest.raises(OSError):
        commit(frame(9, 2, 3), "r3")
    assert storage.read_json(path)["partitions"]["1"]["digest"] == before["partitions"]["1"]["digest"]
    monkeypatch.setattr(storage, "publish", real)
    assert len(storage.recover(spark, tmp_path)) == 1
    assert sorted(r[0] for r in storage.read_partition(spark, folder).collect()) == [2, 3, 9]
    manifest = storage.read_json(path)
    assert manifest["partitions"]["1"]["last_change"]["summary"]["added"] == 2
    next(folder.glob("*.parquet")).unlink()
    with pytest.raises(ArchiveError):
        commit(frame(1), "r4")
    with storage.archive_lock(tmp_path), pytest.raises(ArchiveError), storage.archive_lock(tmp_path):
        pass


class Source:
    """Tables by api name; params filter their rows."""

    def __init__(self, tables):
        self.tables, self.down = tables, set()

    def __call__(self, api, fields, params):
        if api in self.down:
            raise RuntimeError("参数错误")
        rows = self.tables[api]
        names = list(rows[0]) if rows else fields.split(",")
        for key, column in (("period", "end_date"), ("ann_date", "ann_date"), ("f_ann_date", "f_ann_date"), ("report_type", "report_type"), ("trade_date", "trade_date"), ("is_new", "is_new")):
            if key in params:
                rows = [r for r in rows if r[column] == params[key]]
        if "start_date" in params:
            rows = [r for r in rows if params["start_date"] <= r["ann_date"] <= params["end_date"]]
        wanted = [n for n in fields.split(",") if n in names]
        return wanted, [[r[n] for n in wanted] for r in rows][params["offset"] : params["offset"] + params["limit"]]


def archive(spark, tmp_path, source, today="20240420"):
    docs = tmp_path / "docs"
    docs.mkdir(exist_ok=True)
    (docs / "业绩预告.md").write_text(doc([("ts_code", "str"), ("ann_date", "str"), ("end_date", "str"), ("value", "int")]), encoding="utf-8")
    (docs / "股东人数.md").write_text(doc([("ts_code", "str"), ("ann_date", "str"), ("end_date", "str"), ("holder_num", "int")]), encoding="utf-8")
    return Archive(spark, tmp_path / "data", docs, Client(override=source, interval=0), D(today))


def test_backfill_update_verify(spark, tmp_path):
    forecast = [{"ts_code": "A", "ann_date": "20240105", "end_date": "20231231", "value": 1}, {"ts_code": "B", "ann_date": "20240110", "end_date": "20231231", "value": 2}]
    holders = [{"ts_code": "A", "ann_date": "20240401", "end_date": "20240331", "holder_num": 5}, {"ts_code": "C", "ann_date": "20240418", "end_date": "20240331", "holder_num": 6}]
    source = Source({"forecast_vip": forecast, "stk_holdernumber": holders})
    a = archive(spark, tmp_path, source)
    chosen = select_datasets("forecast,stk_holdernumber")
    a.backfill(chosen, D("20231001"), D("20240418"))
    assert a.verify(chosen)[1] == []
    assert sorted(p.name for p in (a.root / "forecast").glob("period=*")) == ["period=20231231", "period=20240331"]
    # A revision, and a window in which one row went and another came.
    forecast[1] = {"ts_code": "B", "ann_date": "20240419", "end_date": "20231231", "value": 3}
    holders[1] = {"ts_code": "B", "ann_date": "20240419", "end_date": "20240331", "holder_num": 7}
    source.down.add("stk_holdernumber")
    with pytest.raises(ArchiveError):
        a.update(chosen, D("20240419"))
    state = lambda n: storage.read_json(a.manifest_path(DATASETS[n]))["update_state"]
    assert state("forecast")["discovery_through"] == "20240419" and "discovery_through" not in state("stk_holdernumber")
    source.down.clear()
    a.update(chosen, D("20240419"))
    assert [r["value"] for r in storage.read_partition(spark, a.folder(DATASETS["forecast"], "20231231")).orderBy("ts_code").collect()] == [1, 3]
    rows = storage.read_partition(spark, a.folder(DATASETS["stk_holdernumber"], "2024"))
    assert sorted(r["ts_code"] for r in rows.collect()) == ["A", "B"]
    assert a.verify(chosen)[1] == []
    a.latest(chosen, D("20231001"), D("20240420"))
    with pytest.raises(ArchiveError):
        a.update(chosen, D("20240401"))
    holders.clear()
    with pytest.raises(ArchiveError) as e:
        a.update(select_datasets("stk_holdernumber"), D("20240420"))
    assert "would replace" in str(e.value) and OverwriteGuardError
    next(a.folder(DATASETS["forecast"], "20231231").glob("*.parquet")).write_bytes(b"x")
    assert any("changed" in x for x in a.verify(chosen)[1])


def test_failed_window_is_asked_for_again(spark, tmp_path):
    """A first event update that publishes one year and fails on another must not lose the failed one's window."""
    row = lambda code, day: {"ts_code": code, "ann_date": day, "end_date": "20231231", "holder_num": 1}
    holders = [row("A", "20231220"), row("B", "20240102")]
    source = Source({"stk_holdernumber": holders})
    a = archive(spark, tmp_path, source, "20240110")
    spec = select_datasets("stk_holdernumber")
    a.backfill(spec, D("20231201"), D("20240103"))
    holders += [row("C", "20231228"), row("D", "20240104")]

    def broken(api, fields, params):
        if params.get("end_date", "") == "20231231":
            raise ValueError("not an error of the archive")  # nor may any other kind end the run
        return source(api, fields, params)

    a.client = Client(override=broken, interval=0, max_retries=1)
    with pytest.raises(ArchiveError):
        a.update(spec, D("20240104"))
    state = storage.read_json(a.manifest_path(spec[0]))["update_state"]
    assert state["pending_window_start"] <= "20231228" and "discovery_through" not in state
    a.client = Client(override=source, interval=0)
    a.update(spec, D("20240106"))
    found = [r["ts_code"] for year in ("2023", "2024") for r in storage.read_partition(spark, a.folder(spec[0], year)).collect()]
    assert sorted(found) == ["A", "B", "C", "D"] and a.verify(spec)[1] == []
    with pytest.raises(ConfigurationError):
        a.update(spec, D("20231130"))


def test_set_difference_counts_both_sides(spark):
    one, other = spark.range(3), spark.range(5)
    counts = lambda a, b: sorted(tuple(r) for r in setops.set_diff_counts(a, b).collect())
    assert counts(one, one) == [("added", 0), ("removed", 0)] and counts(one, other) == [("added", 2), ("removed", 0)]
    assert counts(one, other.selectExpr("cast(id as string) id")) == [("added", 5), ("removed", 3)]


def test_ignored_predicate(spark, tmp_path):
    rows = [{"ts_code": "A", "ann_date": "20240105", "end_date": "20231231", "value": 1}]
    source = Source({"forecast_vip": rows})
    a = archive(spark, tmp_path, lambda api, f, p: source(api, f, {k: v for k, v in p.items() if k in ("offset", "limit")}))
    with pytest.raises(SourceSchemaError):
        a.discover(DATASETS["forecast"], D("20240104"), D("20240104"), "20200101")


def member(path, code, name, begin, end, flag="Y"):
    return (*path, code, name, begin, end, flag)


def test_repair(spark):
    good, bad = member(repair.RIGHT, *repair.CASES[0], ""), member(repair.WRONG, *repair.CASES[0], None)
    other = member(("1", "a", "2", "b", "3", "c"), "000001.SZ", "x", "20200101", "20201231", "N")
    frame = lambda *r: spark.createDataFrame(list(r), ", ".join(f"{c} string" for c in repair.COLUMNS))
    rows, report, blockers = repair.patch(frame(good, bad, other), "20160101", "20240101")
    assert blockers == [] and report["000406.SZ"] == "remove" and report["000817.SZ"] == "not_present"
    assert sorted(tuple(r) for r in rows.collect()) == sorted([good, other])
    assert len(repair.audit(frame(good, bad, other), "20160101", "20240101")["conflicts"]) == 1
    _, report, blockers = repair.patch(frame(bad, other), "20160101", "20240101")
    assert report["000406.SZ"] == "requires_review" and blockers
    for wrong in (member(repair.RIGHT, "x", "y", "20200102", "20200101"), member(repair.RIGHT, "", "y", "20200102", None), member(repair.RIGHT, "x", "y", "20200102", None, "?")):
        with pytest.raises(repair.PatchError):
            repair.audit(frame(wrong), "20160101", "20240101")


def test_mirror(spark, tmp_path):
    source, target = tmp_path / "s", tmp_path / "t"
    spark.range(20).selectExpr("id % 7 as a", "cast(id as string) b").repartition(3).write.parquet(str(source))
    report = mirror.sync(spark, source, target, ("a",))
    assert report["status"] == "published" and report["rows"] == 20 and report["columns"]["a"] == "int64"
    first = mirror.live_version(target)
    mirror.sync(spark, source, target)
    assert mirror.live_version(target) != first and not first.exists()
    spark.range(3).selectExpr("cast(id as int) a", "'x' b").coalesce(1).write.mode("append").parquet(str(source))
    with pytest.raises(ArchiveError):
        mirror.sync(spark, source, target)
    with pytest.raises(ArchiveError):
        mirror.inspect(tmp_path / "nothing")


def test_stream(spark, tmp_path):
    from strandline.streaming.refresh import replacing_sink

    src = tmp_path / "in"
    schema = "d string, v long"
    spark.createDataFrame([("20240101", 1), ("20240105", 2)], schema).coalesce(1).write.parquet(str(src))
    go = lambda: replacing_sink(spark.readStream.schema(schema).parquet(str(src)), tmp_path / "out", "d", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    go()
    spark.createDataFrame([("20240105", 3)], schema).coalesce(1).write.mode("append").parquet(str(src))
    go()
    assert sorted(tuple(r) for r in storage.read_partition(spark, tmp_path / "out" / "data").collect()) == [("20240101", 1), ("20240105", 3)]


def test_command_line(spark, tmp_path):
    assert main(["backfill", "--start-date", "2024", "--end-date", "20240101", "--output-dir", str(tmp_path)], spark, Client(override=lambda *a: ([], []))) == 1
    assert main(["update", "--daily-lookback-days", "0", "--output-dir", str(tmp_path)], spark) == 1
    assert main(["verify", "--apis", "forecast", "--output-dir", str(tmp_path)], spark) == 1
    assert day_text(dt.date(2024, 1, 2)) == "20240102"
