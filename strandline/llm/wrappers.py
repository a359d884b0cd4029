"""Main text of web pages through wrappers inferred for each host.

1. A page is read as a stream of block tags and texts, and its element tree written as an expression in
   which runs of like siblings are one repeated item.
2. Expressions of a host are aligned one after the other. What only one side has becomes optional,
   what repeats becomes a repeated item, texts that differ become open text slots: a union-free regular
   expression, the host's wrapper. Equal expressions are counted before that, and a host's distinct ones
   are folded in salted parts first and then together, so a large host is no large task.
3. The slots of the wrapper are labelled once a host: in the article, in the main part, in a part named as
   content or in the body, outside regions named as menus, headers, footers, sidebars, notices, adverts, forms
   and comments. Each page's texts are then taken by the labels of the slots that they fill: those of the first
   of these containers that the page itself has, as a host may mix templates.
"""

from __future__ import annotations

import html
import json
import operator
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SALTS, DEPTH, CONSTANT_PAGES = 16, 60, 5
#: More hosts than this are joined to the pages; below it their labels (shared by hosts alike) are broadcast.
BROADCAST_HOSTS = 100_000

# Element and class names of HTML pages.
RAW = "script style noscript template iframe svg math object canvas textarea select button datalist".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("html head body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul hr title".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"p"}, "tbody": {"thead", "tr", "td", "th"}, "body": {"head", "title"}}
PHRASING = "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
AWAY = set("head nav aside footer form menu dialog title".split())
AWAY_NAMES = re.compile(
    r"(?:^|[\s_/-])(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side-?bar|widgets?|ads?|adverts?|advertisement|adsense|banner|sponsor(?:ed)?|promo|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|subscribe|newsletter|signup|footer|site-?header|page-?header|masthead|topbar|comments?|comment-?list|replies|respond|disqus|share|sharing|social|related|recommended|pagination|pager|login|search|skip|toolbar|toc)(?:$|[\s_/-])",
    re.I,
)
MAIN_NAMES = re.compile(r"(?:^|[\s_/-])(?:content|main|main-?content|post|post-?body|entry|entry-?content|article|article-?body|story|body-?text)(?:$|[\s_/-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


def events(page: str) -> Iterator[tuple[str, object]]:
    """("open", name and classes), ("close", None), ("text", raw text), ("gap", None): blocks only, well nested."""
    stack: list[str] = []
    for m in TOKEN.finditer(page):
        kind = m.lastgroup
        if m["text"] is not None:
            yield "text", m["text"]
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCK:
            if tag == "br":
                yield "gap", None
            continue
        if m["close"]:
            if tag in stack:
                while True:
                    yield "close", None
                    if stack.pop() == tag:
                        break
            continue
        shut = CLOSES.get(tag, ())
        while stack and (stack[-1] in shut or stack[-1] == "p" and tag in PHRASING):
            stack.pop()
            yield "close", None
        names = " ".join(sorted({w.lower() for g in NAMED.findall(m["attr"]) for w in "".join(g).split()})) if "=" in m["attr"] else ""
        yield "open", f"{tag} {names}" if names else tag
        if tag in VOID:
            yield "close", None
        else:
            stack.append(tag)


# An expression is a list of items. An item: [what, quantity, children, constant text, seen]; what is a
# tag with its classes, or "#" for a text; quantity: "1", "?", "+" or "*"; a long constant text is its
# beginning and a hash of all of it; seen: the distinct pages that have the text.
LONGEST, HASHED = 80, "\0"


def constant_of(text: str) -> str:
    words = SPACE.sub(" ", text).strip()
    return words if len(words) <= LONGEST else words[:LONGEST] + HASHED + xxhash.xxh3_128_hexdigest(words.encode("utf-8", "replace"))


def page_expression(page: str) -> list:
    root: list = []
    stack = [root]
    depth = 0
    for kind, value in events(page):
        if kind == "open":
            depth += 1
            if depth <= DEPTH:  # what is nested deeper counts as part of its ancestor there
                item = [value, "1", [], None, 1]
                stack[-1].append(item)
                stack.append(item[2])
        elif kind == "close":
            if depth <= DEPTH:
                stack.pop()
            depth -= 1
        elif kind == "text" and not value.isspace():
            if stack[-1] and stack[-1][-1][0] == "#":
                stack[-1][-1][3] = None
            else:
                stack[-1].append(["#", "1", [], constant_of(value), 1])
    return folded(root)


def quantity(a: str, b: str) -> str:
    many, none = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return "*" if many and none else "+" if many else "?" if none else "1"


def joined(a: list, b: list, count: Callable = max) -> list:
    """One item for two; count: operator.add for items of different pages, max for what one page may have twice."""
    return [a[0], quantity(a[1], b[1]), aligned(a[2], b[2], count), a[3] if a[3] == b[3] else None, count(a[4], b[4])]


def weighted(items: list, pages: int) -> list:
    """The expression as one of so many distinct pages."""
    return [[w, q, weighted(c, pages), t, pages] for w, q, c, t, _ in items]


def folded(items: list) -> list:
    """Runs of like siblings become one repeated item; so do runs of two or three siblings in turn."""
    items = [[w, q, folded(c), t, n] for w, q, c, t, n in items]
    for period in (1, 2, 3):
        out: list = []
        for item in items:
            out.append(item)
            if len(out) >= 2 * period:
                left, right = out[-2 * period : -period], out[-period:]
                if [x[0] for x in left] == [x[0] for x in right] and (period == 1 or len({x[0] for x in left}) > 1):
                    merged = [joined(x, y) for x, y in zip(left, right)]
                    for x in merged:
                        x[1] = quantity(x[1], "+")
                    out[-2 * period :] = merged
        items = out
    return items


def optional(item: list) -> list:
    return [item[0], "*" if item[1] in "+*" else "?", *item[2:]]


def aligned(a: list, b: list, count: Callable = operator.add) -> list:
    """The least common generalisation of two item lists by their longest common subsequence."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [joined(x, y, count) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(joined(a[i], b[j], count))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    merged: list = []
    for item in out:  # an optional item next to its like is a repeated one
        if merged and merged[-1][0] == item[0]:
            merged[-1] = joined(merged[-1], item)
            merged[-1][1] = quantity(merged[-1][1], "+")
        else:
            merged.append(item)
    return merged


def as_pattern(items: list) -> str:
    """The wrapper in the notation of regular expressions."""
    out = []
    for what, q, children, constant, _ in items:
        one = ("(?:" + re.escape(constant.split(HASHED)[0]) + (".*?)" if HASHED in constant else ")") if constant is not None else "(.*?)") if what == "#" else f"<{what}>{as_pattern(children)}</{what.split()[0]}>"
        out.append(one if q == "1" else f"(?:{one}){q}")
    return "".join(out)


def is_away(what: str, inside: bool) -> bool:
    tag, _, names = what.partition(" ")
    return tag in AWAY or tag == "header" and not inside or bool(names and AWAY_NAMES.search(names))


def slot_labels(items: list) -> dict[str, int]:
    """Path of every element with a text slot -> rank of its container: article 3, main part 2, part named as content 1, body 0; -1: not main text."""
    slots: list[tuple[str, list[str], bool]] = []

    def walk(nodes: list, path: list[str]) -> None:
        for what, _, children, constant, seen in nodes:
            if what == "#":
                slots.append(("/".join(path), path, constant is not None and seen >= CONSTANT_PAGES))
            else:
                walk(children, [*path, what])

    walk(items, [])
    kept = []
    for name, path, constant in slots:
        inside = False
        for what in path:
            if is_away(what, inside):
                break
            inside |= what.split()[0] in ("article", "main")
        else:
            kept.append((name, path, constant))
    tags = lambda path: {w.split()[0] for w in path}
    rules = (lambda p: any(MAIN_NAMES.search(w.partition(" ")[2]) for w in p), lambda p: "main" in tags(p), lambda p: "article" in tags(p))
    rank = {name: max((k for k, rule in enumerate(rules, 1) if rule(path)), default=0) for name, path, _ in kept}
    # A bare text of the body that is the same on many pages, beside texts that differ, belongs to the template; one in
    # an article, a main part or a part named as content is content, however often it stands there.
    if any(not constant for name, _, constant in kept if rank[name] == 0):
        kept = [s for s in kept if not (s[2] and rank[s[0]] == 0 and s[1] and s[1][-1].split()[0] in ("div", "section", "body"))]
    content = {name for name, _, _ in kept}
    return {name: rank[name] if name in content else -1 for name, _, _ in slots}


def main_text(page: str, labels: dict[str, int]) -> str:
    """The texts of the page's own best container: a host's templates need not have the same one."""
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    path: list[str] = []
    rank, depth = labels.get("", -1), 0

    def flush() -> None:
        if parts:
            if text := SPACE.sub(" ", html.unescape("".join(parts))).strip():
                blocks.append((rank, text))
            parts.clear()

    for kind, value in events(page):
        if kind == "text":
            if rank >= 0:
                parts.append(value)
        elif kind == "gap":
            if rank >= 0:
                parts.append(" ")
        else:
            flush()
            if kind == "open":
                depth += 1
                if depth <= DEPTH:
                    path.append(value)
            else:
                if depth <= DEPTH:
                    path.pop()
                depth -= 1
            rank = labels.get("/".join(path), -1)
    flush()
    best = max((r for r, _ in blocks), default=0)
    return "\n".join(text for r, text in blocks if r == best)


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper, labels): wrapper as a pattern, labels as JSON of slot path -> rank of its container (see slot_labels)."""

    def express(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [p or "" for p in batch.column(1).to_pylist()]
            found = [json.dumps(page_expression(p), ensure_ascii=False) for p in read]
            known = [xxhash.xxh64_intdigest(p.encode("utf-8", "replace")) - (1 << 63) for p in read]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(known, pa.int64())], ["host", "expr", "page"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; one wrapper a group, whatever its size, is held at a time. seen is 0 for parts, whose items have it."""
        group, host, held, pages_, out = None, None, None, 0, []
        for batch in batches:
            for h, salt, expr, n, seen in zip(*(c.to_pylist() for c in batch.columns)):
                items = weighted(json.loads(expr), seen) if seen else json.loads(expr)
                if (h, salt) != group:
                    if group is not None:
                        out.append((host, json.dumps(held, ensure_ascii=False), pages_))
                    group, host, held, pages_ = (h, salt), h, items, 0
                else:
                    held = aligned(held, items)
                pages_ += n
            if len(out) > 500:
                yield as_batch(out)
                out = []
        if group is not None:
            out.append((host, json.dumps(held, ensure_ascii=False), pages_))
        yield as_batch(out)

    def as_batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["host", "expr", "n"])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exprs = [json.loads(e) for e in batch.column(1).to_pylist()]
            labels = [json.dumps(slot_labels(e), ensure_ascii=False) for e in exprs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([as_pattern(e) for e in exprs], pa.string()), pa.array(labels, pa.string())], ["host", "pages", "wrapper", "labels"])

    # Exact copies of a page count once where it is asked on how many pages a text stands.
    copies = pages.mapInArrow(express, "host string, expr string, page bigint").groupBy("host", "expr", "page").agg(F.count(F.lit(1)).alias("n"))
    distinct = copies.groupBy("host", "expr").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("seen"))
    salted = distinct.select("host", F.pmod(F.xxhash64("expr"), F.lit(SALTS)).alias("salt"), "expr", "n", "seen")
    part = salted.repartition("host", "salt").sortWithinPartitions("host", "salt", "expr").mapInArrow(fold, "host string, expr string, n bigint")
    whole = part.select("host", F.lit(0).cast("bigint").alias("salt"), "expr", "n", F.lit(0).cast("bigint").alias("seen")).repartition("host").sortWithinPartitions("host", "expr").mapInArrow(fold, "host string, expr string, n bigint")
    return whole.mapInArrow(label, "host string, pages bigint, wrapper string, labels string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, one row for each page; a null or empty page has an empty text.

    Pages with a null url or one without a host share the host ''. Repeated rows stay; an empty table
    gives an empty one; other columns are ignored.
    """
    hosted = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    wrappers = materialise(infer_wrappers(hosted.select("host", "html")), "wrappers")
    kind = pages.schema[id_col].dataType.simpleString()
    spark = pages.sparkSession
    small = wrappers.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    if small:
        alike: dict[str, int] = {}
        host_label = {r["host"]: alike.setdefault(r["labels"], len(alike)) for r in wrappers.select("host", "labels").collect()}
        sent = spark.sparkContext.broadcast((host_label, [json.loads(x) for x in alike]))
        rows = hosted.withColumn("labels", F.lit(None).cast("string"))
    else:
        sent = None
        rows = hosted.join(wrappers.select("host", "labels"), "host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value if sent is not None else None
        last = (None, None)
        for batch in batches:
            texts = []
            for host, page, labels in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist()):
                if known is not None:
                    use = known[1][known[0][host]]
                else:
                    if last[0] != labels:
                        last = (labels, json.loads(labels))
                    use = last[1]
                texts.append(main_text(page or "", use))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.select("host", "html", "page_id", "url", "labels").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
