"""A paginated HTTP source: POST of JSON, strict answers, retries, overlapping pages."""

from __future__ import annotations

import datetime as dt
import email.utils
import hashlib
import json
import random
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.contracts import PAGE_OVERLAP, ArchiveError, SourceSchemaError

# Parts of messages after which a request is not repeated.
FINAL_MESSAGES = ("token不对", "权限", "积分", "参数错误", "字段错误", "接口不存在", "api_name不存在", "ip超限", "多个ip同时使用")
Rows = tuple[list[str], list[list]]


class RateLimiter:
    """At least `interval` seconds between requests of this process."""

    def __init__(self, interval: float):
        self.interval, self.next, self.lock = interval, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            at = max(now, self.next)
            self.next = at + self.interval
        time.sleep(max(0.0, at - now))


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def may_retry(error: Exception) -> bool:
    if isinstance(error, SourceSchemaError):
        return False
    if isinstance(error, urllib.error.HTTPError):
        return error.code in (408, 429) or error.code >= 500
    said = str(error).lower().replace(" ", "")
    return not any(part in said for part in FINAL_MESSAGES)


def retry_after(error: Exception) -> float:
    """Seconds that the server asks for, as a number or a date."""
    value = error.headers.get("Retry-After") if isinstance(error, urllib.error.HTTPError) and error.headers else None
    if not value:
        return 0.0
    try:
        return float(value)
    except ValueError:
        try:
            return (email.utils.parsedate_to_datetime(value) - dt.datetime.now(dt.timezone.utc)).total_seconds()
        except (TypeError, ValueError):
            return 0.0


class Client:
    """One page at a time. `override(api, fields, params) -> (names, rows)` replaces the network in tests."""

    def __init__(self, url: str = "", token: str = "", timeout: float = 120, max_retries: int = 5, interval: float = 0.1, override: Callable[[str, str, dict], Rows] | None = None, sleep: Callable[[float], None] = time.sleep):
        self.url, self.token, self.timeout, self.max_retries, self.override, self.sleep = url, token, timeout, max_retries, override, sleep
        self.limiter = RateLimiter(interval)

    def request(self, api: str, fields: str, params: dict) -> Rows:
        body = json.dumps({"api_name": api, "token": self.token, "params": params, "fields": fields}).encode()
        call = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
        with urllib.request.build_opener(_NoRedirect).open(call, timeout=self.timeout) as answer:
            return parse_answer(answer.read(), fields)

    def page(self, api: str, fields: str, params: dict) -> Rows:
        for attempt in range(1, self.max_retries + 1):
            self.limiter.wait()
            try:
                return (self.override or self.request)(api, fields, params)
            except SourceSchemaError:
                raise
            except Exception as e:
                said = str(e).replace(self.token, "[REDACTED]") if self.token else str(e)
                asked = retry_after(e)
                if not may_retry(e) or attempt == self.max_retries or asked > 60:
                    more = "; the server asks for more than 60 s" if asked > 60 else ""
                    raise ArchiveError(f"{api} failed after {attempt} attempts: {said}{more}") from None
                self.sleep(max(asked, min(30.0, 2 ** (attempt - 1) + random.random())))
        raise AssertionError("unreachable")

    def all_pages(self, api: str, fields: str, params: dict, limit: int, overlap: int = PAGE_OVERLAP) -> Iterator[Rows]:
        """Raw pages until one is shorter than the limit; a page over it, or one seen before, is an error."""
        offset, seen = 0, set()
        while True:
            names, rows = self.page(api, fields, params | {"limit": limit, "offset": offset})
            if len(rows) > limit:
                raise SourceSchemaError(f"{api}: {len(rows)} rows where {limit} were asked for")
            print_ = hashlib.sha256(json.dumps(rows, ensure_ascii=False, default=str).encode("utf-8", "replace")).digest()
            if rows and print_ in seen:
                raise SourceSchemaError(f"{api}: page at {offset} repeats an earlier one")
            seen.add(print_)
            yield names, rows
            if len(rows) < limit:
                return
            offset += limit - min(overlap, limit - 1)


def parse_answer(raw: bytes, fields: str) -> Rows:
    try:
        value = json.loads(raw)
    except ValueError as e:
        raise SourceSchemaError(f"answer is no JSON: {e}") from e
    if not isinstance(value, dict) or type(value.get("code")) is not int:
        raise SourceSchemaError("answer has no whole-number code")
    if value["code"] != 0:
        raise RuntimeError(str(value.get("msg", "no message")))
    data = value.get("data")
    if not isinstance(data, dict) or not isinstance(data.get("fields"), list) or not isinstance(data.get("items"), list):
        raise SourceSchemaError("answer has no data.fields and data.items")
    names, items = data["fields"], data["items"]
    if not names and not items:  # nothing found: the columns that were asked for, without rows
        return fields.split(","), []
    if not all(isinstance(n, str) for n in names) or len(set(names)) != len(names) or any(not isinstance(r, list) or len(r) != len(names) for r in items):
        raise SourceSchemaError("rows do not fit the columns")
    return names, items


def read_all(spark: SparkSession, client: Client, api: str, columns: list[str], params: dict, limit: int, overlap: int = PAGE_OVERLAP) -> tuple[DataFrame, dict]:
    """All pages as distinct rows of text, with the statistics of the pagination."""
    wanted, pages, raw, unique, last = columns, 0, 0, 0, 0
    rows: dict[tuple, None] = {}
    present = columns
    for names, page in client.all_pages(api, ",".join(columns), params, limit, overlap):
        present = [c for c in wanted if c in names] if page else present
        at = [names.index(c) for c in present] if page else []
        these = dict.fromkeys(tuple(None if r[i] is None else str(r[i]) for i in at) for r in page)
        pages, raw, unique, last = pages + 1, raw + len(page), unique + len(these), len(page)
        rows |= these
    schema = StructType([StructField(c, StringType()) for c in present])
    stats = {"pages": pages, "raw_rows": raw, "last_page_rows": last, "cross_page_duplicates": unique - len(rows), "duplicates_removed": raw - len(rows)}
    return spark.createDataFrame(list(rows), schema), stats


class _Query(InputPartition):
    def __init__(self, params: dict):
        self.params = params


class PagedSource(DataSource):
    """spark.read.format("paged_http") with options url, token, api, columns, queries (JSON list), limit, overlap.

    One task for each query; with parallel = false (the default) one task asks them all, since the rate
    limit holds for a process.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_http"

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.options["columns"].split(",")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        queries = json.loads(self.options.get("queries", "[{}]"))
        return [_Query({"all": [q]}) for q in queries] if self.options.get("parallel") == "true" else [_Query({"all": queries})]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        columns = o["columns"].split(",")
        client = Client(o["url"], o.get("token", ""), interval=float(o.get("interval", 0.1)))
        for params in partition.params["all"]:
            for names, page in client.all_pages(o["api"], o["columns"], params, int(o.get("limit", 5000)), int(o.get("overlap", PAGE_OVERLAP))):
                at = {n: i for i, n in enumerate(names)}
                for row in page:
                    yield tuple(None if c not in at or row[at[c]] is None else str(row[at[c]]) for c in columns)
