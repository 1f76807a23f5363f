"""Site templates against counting of subtrees as plain XML, over a site whose menus and notices no word list names."""

import random
import re
import xml.etree.ElementTree as ET
from collections import defaultdict

from termloom.llm.html_text import content_root, extract_text, host_templates, main_text, parse_page

BLOCKS = {"div", "section", "article", "p", "h1", "h2", "ul", "ol", "li", "table", "tr", "td"}
BOXES, LISTS = {"div", "section"}, {"ul", "ol", "table"}


def site(host, n, with_article, rnd):
    """Well-formed pages: some parts are the same on all pages, some on few, some on one."""
    for k in range(n):
        words = lambda m: " ".join(f"{rnd.choice('bcdfg')}{rnd.randrange(500)}" for _ in range(m))
        story = (
            f"<h1>Story {k} of {host}</h1><p>Page {k} uses <a href='/py'>Python</a> number {k} and <span>Spark</span> here.</p>"
            "<p>A line that all stories share.</p><ul><li>first point in words</li><li>second with <a href='/x'>link</a></li></ul>"
            "<div class='hint'><p>Box that all stories share</p></div>"
            "<ul><li><a href='/m1'>Send on</a></li><li><a href='/m2'>Print</a></li></ul>"
            f"<section><p>{words(12)}</p></section><p>{words(20)}</p>"
        )
        before = "<div class='zone-a'><a href='/1'>Start</a> <a href='/2'>Topics</a></div><div><p>We use crumbs on this site</p></div>"
        some = "<div class='zone-b'>On few pages only</div>" if k < 3 else ""
        teaser = "<div><article><h2>Teaser</h2><p>short</p></article></div>" if k % 2 else ""
        after = f"<div id='n{k}' class='zone-c'><p>All rights kept, {host}</p></div>"
        text = f"<article>{story}</article>" if with_article else f"<div>{story}</div>"
        yield f"<html><body>{before}{some}{text}{teaser if with_article else ''}{after}</body></html>"


def flat(text):
    return re.sub(r"\s+", " ", text or "").strip()


def plain(node):
    """A subtree as nested tuples."""
    parts = [flat(node.text)]
    for child in node:
        parts += [plain(child), flat(child.tail)]
    return (node.tag, node.get("class"), node.get("href"), node.get("role"), *[p for p in parts if p])


def length(node, linked=False):
    linked_here = linked or node.tag == "a"
    own = [node.text] + [c.tail for c in node]
    total = sum(len(flat(t)) for t in own)
    in_links = total if linked_here else 0
    for child in node:
        t, a = length(child, linked_here)
        total, in_links = total + t, in_links + a
    return total, in_links


def outermost(node, tag):
    return [node] if node.tag == tag else [x for c in node for x in outermost(c, tag)]


def candidates(page):
    """Elements that can be templates: blocks around the text, boxes and menus in it, never what the longest article lies in."""
    longest = max(outermost(page, "article") or [page], key=lambda a: length(a)[0])
    found = []

    def visit(node, in_text):
        holds = node is longest
        within = in_text or node.tag == "article"
        for child in node:
            holds |= visit(child, within)
        total, in_links = length(node)
        fits = node.tag in BOXES or (node.tag in LISTS and total == in_links) if in_text else node.tag in BLOCKS
        if total and fits and not holds:
            found.append(node)
        return holds

    visit(page, False)
    return found


def lines(node, gone, out):
    """Block texts of a subtree without the nodes in ``gone``."""

    def run(node):
        if node in gone:
            return
        if node.tag in BLOCKS:
            out.append("")
        out[-1] += node.text or ""
        for child in node:
            run(child)
            out[-1] += child.tail or ""
        if node.tag in BLOCKS:
            out.append("")

    out.append("")
    run(node)
    out.append("")


def brute(pages):
    trees = [ET.fromstring(p) for p in pages]
    where = defaultdict(set)
    for k, tree in enumerate(trees):
        for node in candidates(tree):
            where[plain(node)].add(k)
    texts = []
    for tree in trees:
        gone = [n for n in candidates(tree) if len(where[plain(n)]) >= max(5, 0.2 * len(pages))]
        inside = {x for g in gone for x in g.iter()}
        out = []
        for root in [a for a in outermost(tree, "article") if a not in inside] or [tree]:
            lines(root, set(gone), out)
        texts.append("\n".join(flat(x) for x in out if flat(x)))
    return texts


def test_site_equals_brute_force(spark):
    rnd = random.Random(4)
    sites = {f"h{k}.org": list(site(f"h{k}.org", n, k % 2 == 0, rnd)) for k, n in enumerate((30, 30, 12, 12, 4, 4))}
    rows = [(f"http://{host}/{k}", page) for host, pages in sites.items() for k, page in enumerate(pages)]
    # Repeated rows, in all columns and under other ids, change no count.
    rows = [(i, *r) for i, r in enumerate(rows)] + [(0, *rows[0])] * 3 + [(1000 + i, *rows[3]) for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {(r["page_id"]): r["text"] for r in extract_text(frame).collect()}
    expected = [text for pages in sites.values() for text in brute(pages)]
    assert [found[i] for i in range(len(expected))] == expected
    assert {found[1000 + i] for i in range(9)} == {expected[3]}
    assert host_templates(frame).count() == 4


def test_what_templates_remove_and_leave(spark):
    for with_article in (True, False):
        pages = list(site("a.org", 30, with_article, random.Random(5)))
        frame = spark.createDataFrame([(k, "http://a.org/", p) for k, p in enumerate(pages)], "page_id bigint, url string, html string")
        for row in extract_text(frame).collect():
            k, text = row["page_id"], row["text"]
            assert f"Page {k} uses Python number {k} and Spark here." in text.split("\n")
            for gone in ("crumbs", "Topics", "All rights", "Box that all", "Send on", "Print", "Teaser"):
                assert gone not in text
            if with_article:
                assert "A line that all stories share.\nfirst point in words\nsecond with link\n" in text
            assert ("On few pages only" in text) == (k < 3 and not with_article)
        # Without templates, the menus and notices that no list names would stay.
        assert "Box that all" in main_text(content_root(parse_page(pages[0])))


def test_adverts_in_an_article():
    page = "<article><p class='ad'>Buy now</p><p class='read'>a <b class='sponsored'>x</b></p><h2 class='menu'>b</h2></article>"
    assert main_text(content_root(parse_page(page))) == "a\nb"
