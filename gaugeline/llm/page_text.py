"""Main text of web pages by comparing each page with its nearest neighbours by URL.

Pages of a host are ordered by URL path, and the text lines of each page are aligned by a longest common
subsequence with those of the nearest page before and the nearest after that are no copies of it. A copy
is told by what remains: no line of its own on one side or, where one line remains, an article or main
element that is mostly shared. What a page shares with the partner whose path begins alike for longer is
evidence of template; for a line inside an article or main element both partners must share it. The
evidence is counted by host: a line goes, on all pages of the host alike, if at least half of the pages that
hold it and were compared show it. Menus, footers, adverts, forms and the like are told by their element,
and so is the article of the pages of a host without template lines.

Only hashes of lines travel for the comparison; the pages themselves are parsed where they are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.texts import batch_of, filled, map_texts, pa_schema
from gaugeline.session import written
from gaugeline.ship import ship

PLAIN, CHROME, MAIN = 0, 1, 2

# Element names and class words, by what they mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CHROME_TAGS = frozenset("head nav header footer aside form button select option dialog menu svg canvas object audio video map".split())
CHROME_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent footer header login "
    "menu modal nav navbar navigation newsletter notice popup promo related search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu alert".split())

#: Elements that end an open paragraph, and what ends an open item: its siblings, up to its container.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot", "table"), "thead": ("tbody thead tfoot", "table"),
    "tfoot": ("tbody thead tfoot", "table"), "option": ("option", "select optgroup datalist"), "optgroup": ("optgroup", "select"),
}
SIBLINGS = {name: tuple(frozenset(x.split()) for x in sets) for name, sets in SIBLINGS.items()}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/!?a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-zA-Z]+")


def _zone(name: str, attributes: str, outer: int) -> int:
    title = name == "header" and outer == MAIN  # the heading of an article belongs to it
    if outer == CHROME or (name in CHROME_TAGS and not title):
        return CHROME
    if name in ("article", "main"):
        return MAIN
    if attributes and name not in ("html", "body"):
        for key, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            if key.lower() == "role":
                if value in CHROME_ROLES:
                    return CHROME
                if value == "main":
                    return MAIN
            elif any(w in CHROME_WORDS and not (title and w == "header") for w in WORDS.findall(value)):
                return CHROME
    return outer


def _implied_end(names: list[str], name: str) -> int | None:
    """The place of the open element that the start of ``name`` ends."""
    if name in ENDS_P:
        at = len(names) - 1
        while at >= 0 and names[at] in INLINE:
            at -= 1
        return at if at >= 0 and names[at] == "p" else None
    if name in SIBLINGS:
        ended, container = SIBLINGS[name]
        for at in range(len(names) - 1, -1, -1):
            if names[at] in ended:
                return at
            if names[at] in container:
                return None
    return None


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """The text lines of a page in order, and the zone each lies in. A line is the text of a block,
    character references decoded, white space turned into single spaces; empty ones are left out.
    Paragraphs, items and cells without an end tag end where the next one or a block begins."""
    lines: list[str] = []
    zones: list[int] = []
    names: list[str] = []
    outer = [PLAIN]
    held: list[str] = []

    def flush() -> None:
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if line:
                lines.append(line)
                zones.append(outer[-1])

    at, size = 0, len(page)
    while at < size:
        match = TOKEN.search(page, at)
        if match is None:
            held.append(page[at:])
            break
        if match.start() > at:
            held.append(page[at : match.start()])
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["end"]:
            if name not in INLINE:
                flush()
            if name in names:
                while names.pop() != name:
                    outer.pop()
                outer.pop()
            continue
        if name not in INLINE:
            flush()
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if (ended := _implied_end(names, name)) is not None:
            del names[ended:], outer[ended + 1 :]
        if name not in VOID and not match["attributes"].endswith("/"):
            # An inline element that is never closed must not end a block's zone, so both are kept.
            names.append(name)
            outer.append(_zone(name, match["attributes"], outer[-1]))
    flush()
    return lines, zones


# -- alignment ----------------------------------------------------------------------------------


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Bit vectors of the alignment of ``a`` with each beginning of ``b``: a zero at bit i says that
    the common subsequence grows with a[i]. All of them, or the last."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows = full, []
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the common subsequence of ``b`` with each beginning of ``a``."""
    raw = _rows(a, b, False)[0].to_bytes(len(a) // 8 + 1, "little")
    grows = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: len(a)] == 0
    return np.concatenate([[0], np.cumsum(grows)])


#: Cells of an alignment that are worked out at once; larger ones are split, with the same result.
CELLS = 1 << 24


def shared(a: list[int], b: list[int], cells: int = CELLS) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``, in memory linear in both
    beyond ``cells``."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append(a1)
        if a0 == a1 or b0 == b1:
            continue
        own, other = a[a0:a1], b[b0:b1]
        if len(other) == 1:
            if other[0] in own:
                out.append(a0 + own.index(other[0]))
        elif len(own) == 1:
            if own[0] in other:
                out.append(a0)
        elif len(own) * len(other) <= cells:
            rows = _rows(own, other, True)
            i, j = len(own) - 1, len(other) - 1
            while i >= 0 and j >= 0:
                if rows[j] >> i & 1:
                    i -= 1
                elif j > 0 and not rows[j - 1] >> i & 1:
                    j -= 1
                else:
                    out.append(a0 + i)
                    i, j = i - 1, j - 1
        else:
            middle = len(other) // 2  # split where both halves' common subsequences are longest together
            ahead = _lengths(own, other[:middle])
            behind = _lengths(own[::-1], other[middle:][::-1])[::-1]
            cut = a0 + int(np.argmax(ahead + behind))
            todo += [(a0, cut, b0, b0 + middle), (cut, a1, b0 + middle, b1)]
    return sorted(out)


#: The lines of a page outside chrome, as hashes whose last bit is 1 inside an article or main element.
Outline = list[int]


def compared(page: Outline, partner: Outline) -> list[int] | None:
    """Places of the lines that a page shares with another; None if the two are copies."""
    if page == partner:
        return None
    places = shared([x >> 1 for x in page], [x >> 1 for x in partner])
    left = min(len(page), len(partner)) - len(places)
    if left <= 0 or (left == 1 and 2 * sum(page[i] & 1 for i in places) > sum(x & 1 for x in page)):
        return None
    return places


class Page:
    """A page in URL order: its path, its outline, and the nearest pages on both sides that are no copies
    with the lines that it shares with them."""

    __slots__ = ("before", "after", "outline", "path")

    def __init__(self, path: str, outline: Outline):
        self.path, self.outline = path, outline
        self.before: tuple[Page, list[int]] | None = None
        self.after: tuple[Page, list[int]] | None = None

    def look(self, side: str, beside: Page | None, further: list[Page]) -> None:
        """Find the nearest page that is no copy, from the one ``beside``: the next candidate is always the
        nearest one that is no copy of the last; ``further`` ones lie beyond all of these."""
        while beside is not None:
            places = compared(self.outline, beside.outline)
            if places is not None:
                setattr(self, side, (beside, places))
                return
            found = getattr(beside, side)
            beside = found[0] if found else None
        for beside in further:
            places = compared(self.outline, beside.outline)
            if places is not None:
                setattr(self, side, (beside, places))
                return


def linked(pages: list[Page], earlier: list[Page], later: list[Page]) -> None:
    """Find the partners of the pages of a host in URL order; ``earlier`` and ``later`` ones, the nearest
    first, lie in other ranges."""
    for i, page in enumerate(pages):
        page.look("before", pages[i - 1] if i else None, earlier)
    for i in range(len(pages) - 1, -1, -1):
        pages[i].look("after", pages[i + 1] if i + 1 < len(pages) else None, later)


def evidence(pages: list[Page], last: Outline | None) -> dict[int, list[int]]:
    """For each line: the compared pages that hold it, and those of them that show it to be template. Of equal
    pages in a row (``last`` is the one before these) one counts."""
    out: dict[int, list[int]] = {}
    for page in pages:
        again, last = page.outline == last, page.outline
        sides = [s for s in (page.before, page.after) if s]
        if again or not sides:
            continue
        nearest = max(sides, key=lambda s: len(commonprefix([page.path, s[0].path])))
        hits = {page.outline[i] for i in nearest[1] if not page.outline[i] & 1}
        if len(sides) == 2:
            hits |= {page.outline[i] for i in set(sides[0][1]) & set(sides[1][1]) if page.outline[i] & 1}
        for line in set(page.outline):
            if len(sides) == 2 or not line & 1:
                seen = out.setdefault(line, [0, 0])
                seen[0] += 1
                seen[1] += line in hits
    return out


# -- on tables ----------------------------------------------------------------------------------

ORDER = ["host", "path", "_key", "_row"]


def _hashes(lines: list[str]) -> list[int]:
    """63-bit hashes of lines, the last bit left free."""
    return [(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) >> 1 << 1) - (1 << 63) for x in lines]


def outline_of(lines: list[str], zones: list[int]) -> Outline:
    """Coded lines outside chrome."""
    kept = [(x, z) for x, z in zip(lines, zones) if z != CHROME]
    return [h | (z == MAIN) for h, (_, z) in zip(_hashes([x for x, _ in kept]), kept)]


def with_host(pages: DataFrame) -> DataFrame:
    """Add ``host`` (in lower case) and ``path`` of the URL, empty if it has none."""
    url = F.coalesce("_url", F.lit(""))
    return pages.withColumns({
        "host": F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)),
        "path": F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1),
    })


def outlines(pages: DataFrame) -> DataFrame:
    """``host``, ``path``, ``lines`` and ``_part`` of the pages with a host, in ranges of URL order. Hosts of any
    size are spread over ranges."""
    kind = pages.schema["_key"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [outline_of(*lines_of(page)) for page in filled(batch["_html"]).to_pylist()]
        return batch_of(
            _key=batch["_key"], _row=batch["_row"], host=batch["host"], path=batch["path"], lines=pa.array(found, pa.list_(pa.int64()))
        )

    rows = with_host(pages).filter("host <> ''").select("_key", F.xxhash64("_url", "_html").alias("_row"), "_html", "host", "path")
    found = map_texts(rows, work, f"_key {kind}, _row bigint, host string, path string, lines array<bigint>", "_html")
    return written(found.repartitionByRange(*ORDER).withColumn("_part", F.spark_partition_id()), "outlines")


END = "struct<host: string, path: string, lines: array<bigint>>"


def range_ends(placed: DataFrame) -> DataFrame:
    """``_part`` and the first two and last two pages of each range, the second no copy of the first (null if
    there is none on the same host)."""
    ddl = f"_part int, first {END}, second {END}, last {END}, other {END}"
    schema = pa_schema(ddl)

    def no_copy(pages: Iterator[dict], end: dict) -> dict | None:
        return next((p for p in pages if compared(end["lines"], p["lines"]) is not None), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(0, b.num_rows, 1024) for r in b.slice(i, 1024).to_pylist())
        for part, own in groupby(rows, key=lambda r: r.pop("_part")):
            found, pages = {"_part": part}, []
            for _, of_host in groupby(own, key=lambda r: r["host"]):
                pages = list(of_host)
                if "first" not in found:
                    found |= {"first": pages[0], "second": no_copy(iter(pages[1:]), pages[0])}
            found |= {"last": pages[-1], "other": no_copy(reversed(pages[:-1]), pages[-1])}
            yield pa.RecordBatch.from_pylist([found], schema)

    # A task may read several files of the written table, or a part of one.
    dealt = placed.repartition("_part").sortWithinPartitions("_part", *ORDER)
    return written(dealt.select("_part", "host", "path", "lines").mapInArrow(run, ddl), "ends")


def guests(ends: DataFrame) -> DataFrame:
    """``_part``, ``earlier`` and ``later``: the pages of other ranges that are nearest, at most two each. The
    second lies any number of ranges away if all between are copies."""
    row = Window.orderBy("_part")  # one row for each range
    past = row.rowsBetween(Window.unboundedPreceding, -1)
    coming = row.rowsBetween(1, Window.unboundedFollowing)
    pair = lambda a, b: F.array_compact(F.array(a, b))
    return ends.select(
        "_part",
        pair(F.lag("last").over(row), F.last("other", True).over(past)).alias("earlier"),
        pair(F.lead("first").over(row), F.first("second", True).over(coming)).alias("later"),
    )


VOTES = "host string, line bigint, seen bigint, hits bigint"


def votes(placed: DataFrame) -> DataFrame:
    """How many compared pages of each host hold a line, and how many show it to be template. Lines that no
    page shows are left out where the range holds the whole host."""
    columns = [*ORDER, "lines", "_part"]
    schema = pa_schema(VOTES)
    empty = F.lit(None).cast(f"array<{END}>")
    pages = placed.select(*columns, F.lit(1).alias("kind"), empty.alias("earlier"), empty.alias("later"))
    around = guests(range_ends(placed))
    for c in columns[:-1]:
        around = around.withColumn(c, F.lit(None).cast(placed.schema[c].dataType))
    around = around.select(*columns, F.lit(0).alias("kind"), "earlier", "later")
    dealt = pages.unionByName(around).repartition("_part").sortWithinPartitions("_part", "kind", *ORDER)

    def counted(host: str, pages: list[Page], earlier: list[dict], later: list[dict], edge: bool) -> pa.RecordBatch:
        sides = [[Page(p["path"], p["lines"]) for p in side if p["host"] == host] for side in (earlier, later)]
        linked(pages, *sides)
        rows = evidence(pages, sides[0][0].outline if sides[0] else None)
        kept = [(host, line, seen, hits) for line, (seen, hits) in rows.items() if hits or edge]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(list(zip(*kept)) or [[]] * 4, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(0, b.num_rows, 1024) for r in b.slice(i, 1024).to_pylist())
        earlier: list[dict] = []
        later: list[dict] = []
        for (_, kind, host), own in groupby(rows, key=lambda r: (r["_part"], r["kind"], r["host"])):
            if not kind:
                around = next(own)
                earlier, later = around["earlier"], around["later"]
                continue
            edge = any(p["host"] == host for p in (*earlier, *later))  # the host goes on in another range
            found = counted(host, [Page(r["path"], r["lines"]) for r in own], earlier, later, edge)
            if found.num_rows:
                yield found

    return dealt.mapInArrow(run, VOTES).groupBy("host", "line").agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits"))


def templates(pages: DataFrame) -> DataFrame:
    """``host`` and ``gone``, its template lines."""
    found = votes(outlines(pages)).filter("hits > 0 AND 2 * hits >= seen")
    return written(found.groupBy("host").agg(F.collect_list("line").alias("gone")), "templates")


def main_text(page: str, gone: list[int] | None) -> str:
    """The lines that are neither template nor chrome; of a page of a host without template lines (None), those
    that its elements mark as the article, if any."""
    lines, zones = lines_of(page)
    if gone is None:
        wanted = MAIN if MAIN in zones else PLAIN
        return " ".join(x for x, z in zip(lines, zones) if z == wanted)
    out = set(gone)
    kept = [x for x, z in zip(lines, zones) if z != CHROME]
    return " ".join(x for x, h in zip(kept, outline_of(lines, zones)) if h not in out)


def page_texts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every row.

    A null page counts as empty and gives an empty text. Pages with no URL or host, or alone on their
    host, have no partner and are told by their elements. Null keys stay null, repeated rows stay repeated
    (they are copies of each other), other columns are not read, and an empty table gives no rows.
    """
    ship(pages.sparkSession)
    narrow = pages.select(pages[key].alias("_key"), pages[url].alias("_url"), pages[page].alias("_html"))
    # The optimizer broadcasts the hosts' lines if they are few, and else splits large hosts.
    joined = with_host(narrow).join(templates(narrow), "host", "left").select("_key", "_url", "_html", "gone")
    ddl = f"_key {pages.schema[key].dataType.simpleString()}, _url string, text string, n_chars bigint"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, g) for p, g in zip(filled(batch["_html"]).to_pylist(), batch["gone"].to_pylist())]
        return batch_of(_key=batch["_key"], _url=batch["_url"], text=pa.array(texts, pa.string()), n_chars=np.array([len(t) for t in texts], np.int64))

    return map_texts(joined, work, ddl, "_html").withColumnRenamed("_key", key).withColumnRenamed("_url", url)
