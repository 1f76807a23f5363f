from pyspark.sql import functions as F

from termloom import crawl, crawl_and_index, known_links, link_edges
from termloom.operators.crawl import reach


def graph(spark, n=250):
    i = F.col("id")
    a, b = spark.range(n).select(i, (3 * i + 1) % n), spark.range(n).select(i, (7 * i + 2) % n)
    return a.union(b).toDF("src", "dst")


def depths(n, seeds, limit):
    found, level = {s: 0 for s in seeds}, list(seeds)
    for depth in range(1, limit + 1):
        level = sorted({t for s in level for t in ((3 * s + 1) % n, (7 * s + 2) % n)} - set(found))
        found |= {t: depth for t in level}
    return found


def test_reach_by_depth(spark):
    seeds = spark.createDataFrame([(0,)], "node bigint")
    found = {r["node"]: r["depth"] for r in reach(graph(spark), seeds, 3).filter("attempted").collect()}
    assert found == depths(250, [0], 3) and len(found) == 15
    everything = {r["node"]: r["depth"] for r in reach(graph(spark), seeds).collect()}
    assert everything == depths(250, [0], 250)
    only_seeds = reach(graph(spark), seeds, 0)
    assert [tuple(r) for r in only_seeds.filter("attempted").collect()] == [(0, 0, True)]
    assert {r["node"] for r in only_seeds.filter("not attempted").collect()} == {1, 2}


def test_budget_and_frontier_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr("termloom.operators.crawl.BROADCAST_ROWS", -1)
    monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
    seeds = spark.createDataFrame([(0,)], "node bigint")
    found = reach(graph(spark), seeds, max_pages=10).collect()
    order = sorted(depths(250, [0], 3).items(), key=lambda x: (x[1], x[0]))
    assert sorted(r["node"] for r in found if r["attempted"]) == sorted(n for n, _ in order[:10])
    assert len({r["node"] for r in found}) == len(found)
    assert reach(graph(spark), seeds, max_pages=0).collect() == [(0, 0, False)]


PAGES = [
    ("http://a/1?u=x", "text/html", '<p>one storm<a href="2#f">x</a><a href="">e</a><a href="#t">t</a><a href="mailto:q@r">m</a>'),
    ("http://a/2", "text/html", '<a href="/1?again">back</a><a href="3">3</a><a href="http://b/off">off</a> two wind'),
    ("http://a/3", "application/pdf", '<a href="/4">no</a> three'),
    ("http://a/4", "text/html", "four"),
]


def pages(spark):
    return spark.createDataFrame(PAGES, "url string, content_type string, html string")


def states(frame):
    return {r["url"]: (r["depth"], r["status"]) for r in frame.collect()}


def seed(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_edges(spark):
    assert {tuple(r) for r in link_edges(pages(spark)).collect()} == {
        ("http://a/1", "http://a/2"), ("http://a/2", "http://a/1"), ("http://a/2", "http://a/3"), ("http://a/2", "http://b/off"),
    }


def test_status_resume_and_links(spark):
    start = seed(spark, "http://a/1#top")
    state = crawl(pages(spark), start, max_depth=0)
    assert states(state) == {"http://a/1": (0, "visited"), "http://a/2": (1, "pending")}
    everything = crawl(pages(spark), start)
    assert states(everything) == {
        "http://a/1": (0, "visited"), "http://a/2": (1, "visited"), "http://a/3": (2, "bad"), "http://b/off": (2, "bad"),
    }
    assert sorted(r["url"] for r in known_links(everything).collect()) == ["http://a/1", "http://a/2"]
    resumed = crawl(pages(spark), seed(spark, "http://a/4", "http://a/1"), state=state)
    assert states(resumed) == {
        "http://a/1": (0, "visited"), "http://a/2": (0, "visited"), "http://a/4": (0, "visited"),
        "http://a/3": (1, "bad"), "http://b/off": (1, "bad"),
    }
    limited = crawl(pages(spark), start, max_pages=2)
    assert states(limited)["http://a/3"] == (2, "pending")
    assert states(crawl(pages(spark), seed(spark))) == {}


def test_redirected_page_resolves_links_at_its_final_url(spark):
    rows = [("http://a/old", "http://c/new/x", '<a href="y">y</a>')]
    moved = spark.createDataFrame(rows, "url string, final_url string, html string")
    assert [tuple(r) for r in link_edges(moved).collect()] == [("http://a/old", "http://c/new/y")]


def test_crawl_and_index(spark, tmp_path):
    state, index = crawl_and_index(pages(spark), seed(spark, "http://a/1"), str(tmp_path / "ix"), "a")
    assert sorted(r["doc_id"] for r in index.doc_stats.collect()) == ["http://a/1?u=x", "http://a/2"]
    assert {r["term"] for r in index.postings.collect()} >= {"storm", "wind", "one", "two"}


def test_a_long_chain_costs_the_same_per_level(spark, monkeypatch):
    sizes = []
    from termloom.operators import crawl as module

    def watched(*args):
        frame = follow(*args)
        sizes.append(frame._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return frame

    follow = module.next_level
    monkeypatch.setattr(module, "next_level", watched)
    chain = spark.range(62).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = reach(module.stage(chain, "chain"), spark.createDataFrame([(0,)], "node bigint")).collect()
    assert {r["node"]: r["depth"] for r in found} == {k: k for k in range(63)}
    assert len(sizes) == 63 and max(sizes) <= 3


def test_one_page_per_link(spark, tmp_path):
    rows = [("http://a/1?v=2", "<p>second"), ("http://a/1?v=1", "<p>first"), ("http://a/1?v=1", "<p>first")]
    pages = spark.createDataFrame(rows, "url string, html string")
    seeds = spark.createDataFrame([("http://a/1",)], "url string")
    state, index = crawl_and_index(pages, seeds, str(tmp_path / "ix"), "c", max_pages=1)
    assert [tuple(r) for r in state.collect()] == [("http://a/1", 0, "visited")]
    assert [r["doc_id"] for r in index.doc_stats.collect()] == ["http://a/1?v=1"]
