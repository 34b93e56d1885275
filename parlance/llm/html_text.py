"""Main text of web pages by differencing against the page of the nearest URL.

A page's blocks are read from its markup as lines. Pages are sorted by host and
path; each is paired with the neighbour that shares the longest path and is no
copy of it, and the longest common subsequence of the two pages' lines is what
the site repeats: it is deleted, but inside an article or main element only
where a second neighbour repeats it too, as articles may quote one another.
Markup then takes away what no other page repeats: lines of menus, footers,
adverts and the like, and lines outside the article element where this holds
most of what is left.

Ranges of the sorted addresses go to tasks together with the pages next to
them, so a page meets the same neighbours however many ranges there are.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import map_blocks, released

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")
_RAW = frozenset("script style textarea title xmp iframe noembed noframes template noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose lines are read, to be compared, but are no text; and those that give no lines.
_SKIP = frozenset("nav footer aside menu dialog".split())
_SILENT = frozenset("head form fieldset button select svg object audio video canvas".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_INLINE_OVER_P = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())
_HINTS = frozenset(
    "ad ads adbox adslot adunit adsbygoogle advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent copyright disclaimer discussion disqus footer gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended recommendations related replies respond share sharing sidebar sidemenu sidenav social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Hints that mean nothing inside an article, whose own header is text.
_OUTER = frozenset("header masthead banner toolbar topbar notice notices alert widget".split())
#: Pages on each side that are looked at, and how many must repeat a line of an article.
AROUND, REPEATS = 2, 2
#: Ranges of addresses a task.
RANGES = 4
#: Matching pairs of lines up to which they are listed one by one.
LISTED = 1 << 20
#: Words that turn a hint into a statement about the page's layout.
_LAYOUT = frozenset("with has no without".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


def _unwanted(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _SKIP:
        return True
    if tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body", "article", "main") and "comment" not in attrs:
        return False
    hints = _HINTS - _OUTER if in_article else _HINTS
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _SPLIT.split(one) if w]
                if not _LAYOUT.intersection(words) and ("".join(words) in hints or any(w in hints for w in words)):
                    return True
        if name == "role" and value.lower() in _ROLES:
            return True
    return False


def _hidden(attrs: str) -> bool:
    if not attrs:
        return False
    bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", bare, re.IGNORECASE) or re.search(r"display\s*:\s*none", attrs, re.IGNORECASE) or re.search(r"aria-hidden\s*=\s*[\"']?true", attrs, re.IGNORECASE))


class _Markup:
    """A page cut into pieces of text and markup, in time proportional to its length."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.none: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """Where `what` next occurs, -1 if nowhere; a search that failed is not made again."""
        if at >= self.none.get(what, len(self.page) + 1):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.none[what] = min(at, self.none.get(what, at))
        return found

    def tag_end(self, at: int) -> int:
        """The `>` that ends a tag; those in quoted values of attributes don't. A quote without an end is no quote."""
        page = self.page
        first = self.find(">", at)
        if first < 0:
            return -1
        while m := _STOP.search(page, at):
            if m[0] == ">":
                return m.start()
            k = m.start() - 1
            while k > 0 and page[k].isspace():
                k -= 1
            end = self.find(m[0], m.end()) if page[k] == "=" else -1
            at = end + 1 if end >= 0 else m.end()
        return first

    def pieces(self) -> Iterator[tuple[str, str, str]]:
        """(kind, name or text, attributes) with kinds text, open, close and data."""
        page, at = self.page, 0
        while at < len(page):
            lt = self.find("<", at)
            if lt < 0:
                yield "text", page[at:], ""
                return
            if lt > at:
                yield "text", page[at:lt], ""
            at = lt
            if page.startswith("<!--", at):
                end = self.find("-->", at + 4)
                at = end + 3 if end >= 0 else len(page)
            elif page.startswith("<![CDATA[", at):
                end = self.find("]]>", at)
                yield "data", page[at + 9 : end if end >= 0 else len(page)], ""
                at = end + 3 if end >= 0 else len(page)
            elif page.startswith(("<!", "<?"), at):
                end = self.find(">", at)
                at = end + 1 if end >= 0 else len(page)
            else:
                closing = page.startswith("</", at)
                name = _NAME.match(page, at + 1 + closing)
                end = self.tag_end(name.end()) if name else -1
                if end < 0:
                    yield "text", "<", ""
                    at += 1
                    continue
                tag = name[0].lower()
                yield ("close" if closing else "open"), tag, page[name.end() : end]
                at = end + 1
                if not closing and tag in _RAW:
                    stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                    at = stop.end() if stop else len(page)


#: Kinds of lines.
PLAIN, ARTICLE, OUTSIDE = 0, 1, 2


def parse_blocks(page: str) -> tuple[list[str], list[int]]:
    """Lines of a page, and the kind of each: in an article or main element, in an element that holds no text, or neither."""
    lines: list[str] = []
    kinds: list[int] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool, bool]] = []  # tag; 1 unwanted or 2 silent here; article opened here
    open_ = Counter()
    skipped = silent = articles = 0

    def flush() -> None:
        if text:
            if line := " ".join("".join(text).split()):
                lines.append(line)
                kinds.append(OUTSIDE if skipped else ARTICLE if articles else PLAIN)
            text.clear()

    def pop_to(k: int) -> None:
        nonlocal skipped, silent, articles
        for tag, skip, art in stack[k:]:
            open_[tag] -= 1
            skipped -= skip == 1
            silent -= skip == 2
            articles -= art
        del stack[k:]

    for kind, tag, attrs in _Markup(page).pieces():
        if kind == "text" or kind == "data":
            if not silent:
                text.append(html.unescape(tag) if kind == "text" else tag)
        elif kind == "close":
            if tag in _BLOCK:
                flush()
            if open_[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                if any(skip == 1 or art for _, skip, art in stack[k:]):
                    flush()
                pop_to(k)
        elif tag == "br":
            if not silent:
                text.append(" ")
        else:
            if tag in _BLOCK:
                flush()
                if open_["p"] or open_[tag]:
                    k = len(stack)
                    while k and stack[k - 1][0] in _INLINE_OVER_P:
                        k -= 1
                    if k and (stack[k - 1][0] == "p" or tag == stack[k - 1][0] in ("li", "dd", "dt", "option", "tr", "td", "th")):
                        pop_to(k - 1)
            if tag in _RAW or tag in _VOID or attrs.endswith("/") and tag in ("p", "div", "span"):
                continue
            skip = 0 if silent else 2 if tag in _SILENT or _hidden(attrs) else int(not skipped and _unwanted(tag, attrs, articles > 0))
            art = tag in ("article", "main") or 'role="main"' in attrs
            if skip == 1 or art:
                flush()
            stack.append((tag, skip, art))
            open_[tag] += 1
            skipped += skip == 1
            silent += skip == 2
            articles += art
    flush()
    return lines, kinds


def _row(left: list[str], right: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of `left` with every beginning of `right`, by bits."""
    spots: dict[str, int] = {}
    for j, line in enumerate(right):
        spots[line] = spots.get(line, 0) | 1 << j
    full = (1 << len(right)) - 1
    v = full
    for line in left:
        if mask := spots.get(line):
            u = v & mask
            v = (v + u | v - u) & full
    out = [0]
    for bit in reversed(format(v, f"0{max(1, len(right))}b")):
        out.append(out[-1] + (bit == "0"))
    return out[: len(right) + 1]


def _common(left: list[str], right: list[str], at: int, out: list[bool]) -> None:
    """Marks a longest common subsequence in out[at:], in memory proportional to the lines (Hirschberg)."""
    while left and right and left[0] == right[0]:
        out[at] = True
        left, right, at = left[1:], right[1:], at + 1
    if not left or not right:
        return
    if len(left) == 1:
        out[at] = left[0] in right
        return
    half = len(left) // 2
    ahead, behind = _row(left[:half], right), _row(left[half:][::-1], right[::-1])
    cut = max(range(len(right) + 1), key=lambda j: ahead[j] + behind[len(right) - j])
    _common(left[:half], right[:cut], at, out)
    _common(left[half:], right[cut:], at + half, out)


def common_lines(left: list[str], right: list[str]) -> list[bool]:
    """Which lines of `left` are in a longest common subsequence with `right` (Hunt and Szymanski, by bits where lines repeat much)."""
    times = Counter(right)
    if sum(times[line] for line in left) > LISTED:
        known = set(left)
        mine = [i for i, line in enumerate(left) if line in times]
        part, out = [False] * len(mine), [False] * len(left)
        _common([left[i] for i in mine], [line for line in right if line in known], 0, part)
        for i, both in zip(mine, part, strict=True):
            out[i] = both
        return out
    spots: dict[str, list[int]] = {}
    for j in range(len(right) - 1, -1, -1):
        spots.setdefault(right[j], []).append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i, line in enumerate(left):
        for j in spots.get(line, ()):
            k = bisect.bisect_left(tails, j)
            node = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(node)
            else:
                tails[k], links[k] = j, node
    out = [False] * len(left)
    node = links[-1] if links else None
    while node:
        out[node[0]] = True
        node = node[1]
    return out


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def settle(lines: list[str], kinds: list[int], path: str, around: list[tuple]) -> tuple[str, int, int | None]:
    """Text of a page, lines that its partner repeats, and the partner's place in `around` (path, lines), nearest first."""

    def size(of: list[bool], least: int = PLAIN) -> int:
        return sum(len(line) for line, kind, x in zip(lines, kinds, of, strict=True) if x and least <= kind < OUTSIDE)

    whole, inside = size([True] * len(lines)), size([True] * len(lines), ARTICLE)
    marked = 2 * inside >= whole
    order = sorted(range(len(around)), key=lambda i: -_shared_prefix(around[i][0], path))
    partner, shared = None, [False] * len(lines)
    times = [0] * len(lines)
    for i in order:
        both = common_lines(lines, around[i][1])
        # a copy repeats half of the article or more, or all of a page that marks none
        if whole and (2 * size(both, ARTICLE) >= inside if marked else size(both) == whole):
            continue
        if partner is None:
            partner, shared = i, both
        times = [n + x for n, x in zip(times, both, strict=True)]
    left = [kind != OUTSIDE and not (both and (kind != ARTICLE or n >= REPEATS)) for kind, both, n in zip(kinds, shared, times, strict=True)]
    inner = [x and kind == ARTICLE for x, kind in zip(left, kinds, strict=True)]
    if 2 * size(inner) >= size(left):
        left = inner
    return "\n".join(line for line, x in zip(lines, left, strict=True) if x), sum(shared), partner


def _order(host: str, path: str, doc) -> tuple:
    return host, path, doc is not None, 0 if doc is None else doc


def _ranges(keys: DataFrame, owners: int) -> list[tuple[tuple, tuple, tuple]]:
    """Ranges of the sorted keys: the first key among the neighbours before a range, its own first key, the last key among the neighbours after it.

    A range gives its outer keys alone, so what reaches the driver is a few
    keys a range, like the bounds of any sort.
    """

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: list[dict] = []
        last: list[dict] = []
        for batch in batches:
            for row in batch.select(["host", "path", "id"]).to_pylist():
                if last and row == last[-1]:
                    continue
                if len(first) < AROUND:
                    first.append(row)
                last = [*last, row][-AROUND:]
        if first:
            yield pa.RecordBatch.from_pylist(first + [x for x in last if x not in first], batch.select(["host", "path", "id"]).schema)

    spread = keys.repartitionByRange(owners, "host", "path", "id").sortWithinPartitions("host", "path", "id").withColumn("part", F.spark_partition_id())
    found = spread.mapInArrow(outer, T.StructType([keys.schema[c] for c in ("host", "path", "id")])).withColumn("part", F.spark_partition_id()).collect()
    ends = sorted((_order(r["host"], r["path"], r["id"]), r["part"]) for r in found)
    keys_ = [k for k, _ in ends]
    starts = [i for i, (_, part) in enumerate(ends) if not i or part != ends[i - 1][1]]
    return [(keys_[max(0, a - AROUND)], keys_[a], keys_[min(b + AROUND, len(keys_)) - 1]) for a, b in zip(starts, [*starts[1:], len(keys_)], strict=bool(starts))]


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", partitions: int | None = None) -> DataFrame:
    """Rows (id, url, text, n_chars, n_shared, paired_with) for every page.

    text joins the kept lines by a line feed; n_shared counts lines that the
    nearest page of the same host repeats that is no copy, and paired_with is
    that page's id (null if the pages next to it in the order of addresses,
    AROUND on each side, are of other hosts or copies).
    Null html gives an empty text; a null url has an empty host and path;
    repeated rows repeat, and count as copies of each other; an empty table
    gives no rows; other columns are not read.
    """
    kinds = {c: pages.schema[c].dataType for c in (id_col, url_col)}
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    source = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"), path.alias("path"), F.col(f"`{html_col}`").alias("html"))
    owners = partitions or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = _ranges(source.select("host", "path", "id"), RANGES * owners)
    shared = pages.sparkSession.sparkContext.broadcast(ranges)
    fields = [T.StructField("part", T.IntegerType()), T.StructField("guest", T.BooleanType()), T.StructField("id", kinds[id_col]), T.StructField("url", kinds[url_col]), T.StructField("host", T.StringType()), T.StructField("path", T.StringType())]
    lined = T.StructType([*fields, T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("kinds", T.ArrayType(T.IntegerType()))])

    def parse(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Lines of every page for the range that it is in, and for those next to it that look at it."""
        starts = [r[1] for r in shared.value]
        part, guest, row, lines, kind = [], [], [], [], []
        for i in range(batch.num_rows):
            found = parse_blocks(batch.column("html")[i].as_py() or "")
            key = _order(*(batch.column(c)[i].as_py() for c in ("host", "path", "id")))
            own = bisect.bisect_right(starts, key) - 1
            near = [own]
            k = own - 1
            while k >= 0 and key <= shared.value[k][2]:
                near.append(k)
                k -= 1
            k = own + 1
            while k < len(starts) and key >= shared.value[k][0]:
                near.append(k)
                k += 1
            for k in near:
                part.append(k)
                guest.append(k != own)
                row.append(i)
                lines.append(found[0])
                kind.append(found[1])
        take = batch.select(["id", "url", "host", "path"]).take(pa.array(row, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(guest, pa.bool_()), *take.columns, pa.array(lines, pa.list_(pa.string())), pa.array(kind, pa.list_(pa.int32()))], lined.names)

    parsed = map_blocks(source, "html", parse, lined)
    placed = parsed.repartition(owners, "part").sortWithinPartitions("part", "host", "path", "id", F.xxhash64("lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        size = 0
        # pages before the one to settle, it and those after
        window: list[dict] = []
        at = 0

        def settled(i: int) -> Iterator[tuple]:
            own = window[i]
            if own["guest"]:
                return
            around = [x for j in range(1, AROUND + 1) for x in ([window[i - j]] if i >= j else []) + ([window[i + j]] if i + j < len(window) else []) if (x["part"], x["host"]) == (own["part"], own["host"])]
            text, n, partner = settle(own["lines"], own["kinds"], own["path"], [(x["path"], x["lines"]) for x in around])
            yield own["id"], own["url"], text, n, None if partner is None else around[partner]["id"]

        def pack() -> pa.RecordBatch:
            text = [x[2] for x in done]
            cols = [pa.array([x[0] for x in done], types[0]), pa.array([x[1] for x in done], types[1]), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array([x[3] for x in done], pa.int64()), pa.array([x[4] for x in done], types[0])]
            return pa.RecordBatch.from_arrays(cols, ["id", "url", "text", "n_chars", "n_shared", "paired_with"])

        for batch in batches:
            types = batch.column("id").type, batch.column("url").type
            for i in range(batch.num_rows):
                window.append({c: batch.column(c)[i].as_py() for c in lined.names})
                if len(window) - at > AROUND:
                    for row in settled(at):
                        done.append(row)
                        size += len(row[2])
                    at += 1
                    if at > AROUND:
                        del window[0]
                        at -= 1
                if size > 1 << 20:
                    yield pack()
                    done, size = [], 0
        done += [row for i in range(at, len(window)) for row in settled(i)]
        if done:
            yield pack()

    result = [T.StructField("id", kinds[id_col]), T.StructField("url", kinds[url_col]), T.StructField("text", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("n_chars", "n_shared")), T.StructField("paired_with", kinds[id_col])]
    out = placed.mapInArrow(released(run), T.StructType(result))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_shared", "paired_with")
