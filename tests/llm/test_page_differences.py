"""Template lines go whatever their element, and copies next to a page are passed over."""

import random
from collections import Counter, defaultdict
from os.path import commonprefix

import pytest

from gaugeline.llm import page_text

SF = "/root/testdata/sf0.01"


def _lcs(a, b):
    """Places in ``a`` of a longest common subsequence, from the table of lengths."""
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            size[i][j] = size[i + 1][j + 1] + 1 if a[i] == b[j] else max(size[i + 1][j], size[i][j + 1])
    return size[0][0]


def _plain(rows):
    """Texts of (page_id, url, html) rows by comparing each page of a host with all others in URL order."""
    hosts = defaultdict(list)
    for key, url, html in rows:
        if url and "://" in url and url.split("://")[1].split("/")[0]:
            rest = url.split("://", 1)[1]
            lines, zones = page_text.lines_of(html or "")
            own = [(x, z == page_text.MAIN) for x, z in zip(lines, zones) if z != page_text.CHROME]
            cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
            hosts[rest[:cut].lower()].append((rest[cut:].split("?")[0].split("#")[0], key is not None, key or 0, own))
    template = {}
    for host, pages in hosts.items():
        pages.sort(key=lambda p: p[:3])
        seen, hits = Counter(), Counter()
        for i, (path, _, _, own) in enumerate(pages):
            if not i or own != pages[i - 1][3]:
                sides = []
                for way in (range(i - 1, -1, -1), range(i + 1, len(pages))):
                    for j in way:
                        other, texts = pages[j][3], [x for x, _ in own]
                        both = [x for x, _ in other]
                        left = min(len(own), len(other)) - _lcs(texts, both)
                        common = Counter(texts) & Counter(both)
                        main = [x for x, z in own if z]
                        if left == 0 or (left == 1 and 2 * sum(x in common for x in main) > len(main)):
                            continue
                        sides.append((len(commonprefix([path, pages[j][0]])), common))
                        break
                best = max(sides, key=lambda s: s[0], default=None)
                for line, main in set(own):
                    if len(sides) == 2 or (sides and not main):
                        seen[line, main] += 1
                        hits[line, main] += all(line in c for _, c in sides) if main else line in best[1]
        template[host] = {k for k in seen if hits[k] and 2 * hits[k] >= seen[k]}
    out = Counter()
    for key, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        gone = template.get(rest[: min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])].lower())
        lines, zones = page_text.lines_of(html or "")
        wanted = [page_text.PLAIN, page_text.MAIN] if gone else [page_text.MAIN if page_text.MAIN in zones else page_text.PLAIN]
        text = " ".join(x for x, z in zip(lines, zones) if z in wanted and (x, z == page_text.MAIN) not in (gone or ()))
        out[key, url, text, len(text)] += 1
    return out


def _made_up():
    """Pages whose lines stand in one order everywhere, so that alignment and common lines agree."""
    draw, rows = random.Random(11), []
    for h in range(6):
        for i in range(draw.choice((1, 2, 3, 25))):
            parts = ["<p>Menu<p>Welcome", "<article><p>Share this"] + [f"<p>Line {j} of {h} {i}" for j in range(draw.randint(0, 4))]
            parts.insert(2, "<p>Passage" if draw.random() < 0.2 else "")
            page = "".join(parts) + "</article>" + ("<p>All rights" if draw.random() < 0.9 else "")
            page = page if draw.random() < 0.7 else page.replace("article", "div")
            url = f"http://h{h}.example/{draw.choice('ab')}/{i:02d}?q={i}"
            rows += [(len(rows) + n, url, page) for n in range(draw.choice((1, 1, 1, 4)))]
    return [*rows, rows[0], (None, rows[0][1], rows[0][2]), (900, None, "<p>x"), (901, "http://h0.example", None), (902, "nonsense", "<p>y")]


@pytest.mark.parametrize("parts", ["true", "false"])
def test_whole_query_against_all_pages_of_a_host(spark, parts):
    rows = _made_up()
    pages = spark.createDataFrame([(*r, "h", 1, 2) for r in rows], "page_id bigint, url string, html string, host string, gone int, _part int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)
    try:
        found = page_text.page_texts(pages.repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter(map(tuple, found)) == _plain(rows)


def test_article_lines_of_the_given_pages_stay(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    found = page_text.page_texts(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    told = {key: page_text.main_text(html, None) for key, _, html in rows}
    assert sum(r["text"] != told[r["page_id"]] for r in found) == 0  # 10 of 250 lost lines when one neighbour decided


def test_ends_of_elements_without_end_tags():
    text = lambda page: page_text.main_text(page, None)
    assert text("<article><p class='share'>S<p>Body text</article>") == "Body text"
    assert text("<article><ul><li class=ad>Buy<li>One<ul><li>in</ul><li>Two</ul><p>End</article>") == "One in Two End"
    assert text("<article><p class=ad><b>Buy<div>Own</div></article>") == "Own"
    assert text("<article><table><tr><td class=ad>Buy<td>a<tr><td>b</table><dl><dt class=menu>m<dd>d</dl></article>") == "a b d"
    assert text("<article><div class=ad><p>x<p>y</div>Own</article>") == "Own"
    assert text("<article><header><h1>Title</h1></header><p>Body<footer>f</footer></article>") == "Title Body"
    assert text("<article><header class='post-header'><h1>Title</h1></header>x</article><header>Site</header>") == "Title x"


def _texts(spark, rows, parts=4):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    return {r["page_id"]: r["text"] for r in page_text.page_texts(pages).collect()}


def test_template_inside_and_own_text_outside_the_article(spark):
    page = "<p>Site<article><p>Share this<p>One of {0}<p>Two of {0}<p>Read more</article><p>Note on {0}<p>All rights"
    found = _texts(spark, [(i, f"http://a.example/{i}", page.format(i)) for i in range(9)])
    assert all(found[i] == f"One of {i} Two of {i} Note on {i}" for i in range(9))
    alone = _texts(spark, [(1, "http://a.example/1", page.format(1))])
    assert alone[1] == "Share this One of 1 Two of 1 Read more"


def test_short_article_in_a_long_template(spark):
    page = "<div>Home</div><p>Menu<p>Welcome<p>One of {0}<p>Two of {0}<p>Imprint<p>All rights"
    found = _texts(spark, [(i, f"http://a.example/{i}", page.format(i)) for i in range(9)])
    assert all(found[i] == f"One of {i} Two of {i}" for i in range(9))


def test_near_copy_of_an_article(spark):
    page = "<article><p>{0}<p>Two<p>Three<p>Four</article>"
    found = _texts(spark, [(i, f"http://a.example/{i}", page.format(f"Day {i}")) for i in range(2)])
    assert found == {i: f"Day {i} Two Three Four" for i in range(2)}


def test_pages_between_copies_are_differenced(spark):
    page = "<p>Menu<p>Welcome<p>One of {0}<p>Two of {0}<p>All rights"
    rows = [(i, f"http://a.example/{i:03d}", page.format(i // 30)) for i in range(120)]  # runs across ranges
    rows += [(1000 + i, f"http://b.example/{i}", page.format("b")) for i in range(40)]  # copies only
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = _texts(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(found[i] == f"One of {i // 30} Two of {i // 30}" for i in range(120))
    assert all(found[1000 + i] == "Menu Welcome One of b Two of b All rights" for i in range(40))
