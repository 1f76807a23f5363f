"""Level-by-level traversal of a link graph, with the status of every link found."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import DEFAULT_MAX_DEPTH
from ..functions.urls import canonical_url
from ..session import new_path, stage
from ..sources.documents import first_per_document, html_pages, page_documents
from .joins import BROADCAST_CHARS, BROADCAST_ROWS, join_hot
from .links import link_edges
from .numbering import number_rows


# In a graph with at least so many links, a frontier of more than one node in so many links is met from the side of the
# nodes not seen yet. Below, laying the links out for it costs more than it saves.
BOTTOM_UP_EDGES, BOTTOM_UP_SHARE = 1_000_000, 20


@dataclass(frozen=True)
class _Size:
    """Rows of a frame, and length of its strings."""

    rows: int
    chars: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.chars <= BROADCAST_CHARS


class _Seen:
    """Nodes met so far: one table, partitioned by level and bucketed by node.

    A level is one partition, so the frontier is read alone; all levels share the buckets, so that whatever is joined
    with the seen nodes comes to them and they are never shuffled, however many there are. There are as many buckets as
    shuffle partitions, which is how rows that were made distinct lie already.
    """

    KNOWN = -1

    def __init__(self, spark: SparkSession):
        self._spark, self._path = spark, new_path(spark, "seen")
        self._name = "seen_" + self._path.rsplit("-", 1)[1]
        self._buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._type = "string"

    def add(self, nodes: DataFrame, depth: int) -> _Size:
        """Write a level, return its size."""
        self._type = nodes.schema["node"].dataType.simpleString()
        rows = nodes.select("node", F.lit(depth).cast("bigint").alias("depth"))
        writer = rows.write.mode("append").partitionBy("depth").bucketBy(self._buckets, "node").sortBy("node")
        writer.option("path", self._path).saveAsTable(self._name)
        chars = F.coalesce(F.sum(F.length("node").cast("bigint")), F.lit(0)) if self._type == "string" else F.lit(0)
        return _Size(*self.level(depth).agg(F.count("*"), chars).first())

    def level(self, depth: int) -> DataFrame:
        return self._spark.table(self._name).filter(F.col("depth") == depth).select("node")

    def nodes(self) -> DataFrame:
        return self._spark.table(self._name).select("node")

    def close(self) -> DataFrame:
        """``node, depth`` of all levels, from the files; the catalog forgets the table."""
        self._spark.sql(f"DROP TABLE {self._name}")
        rows = self._spark.read.schema(f"node {self._type}, depth bigint").parquet(self._path)
        return rows.filter(F.col("depth") > self.KNOWN)


class _Graph:
    """Links in the two layouts that a traversal reads."""

    def __init__(self, edges: DataFrame):
        self.edges = edges
        self.n_edges = edges.count()

    @cached_property
    def by_target(self) -> DataFrame:
        """Links bucketed like the seen nodes by where they lead."""
        spark = self.edges.sparkSession
        path, buckets = new_path(spark, "links"), int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = "links_" + path.rsplit("-", 1)[1]
        rows = self.edges.select("src", "dst").repartition(buckets, "dst")
        rows.write.bucketBy(buckets, "dst").sortBy("dst").option("path", path).saveAsTable(name)
        self._table = name
        return spark.table(name)

    @cached_property
    def links_per_source(self) -> DataFrame:
        return stage(self.edges.groupBy("src").agg(F.count("*").alias("_rows")), "link-counts")

    def close(self) -> None:
        if "by_target" in self.__dict__:
            self.edges.sparkSession.sql(f"DROP TABLE {self._table}")


def next_level(graph: _Graph, frontier: DataFrame, size: _Size, seen: _Seen) -> DataFrame:
    """``node``: distinct targets of the frontier's links that are not seen yet.

    From a small frontier the links are followed, and what they lead to is brought to the seen nodes. When the frontier
    is a large share of the graph, or too large to be broadcast, the links that lead to nodes not seen yet are looked
    up first, which lie in the same buckets as the seen nodes, and only those meet the frontier; late in a traversal
    few are left.
    """
    few = graph.n_edges < BOTTOM_UP_EDGES or size.rows * BOTTOM_UP_SHARE <= graph.n_edges
    if size.fits_broadcast and few:
        links = graph.edges
        reached = links.join(F.broadcast(frontier), links["src"] == frontier["node"], "left_semi")
        return reached.select(F.col("dst").alias("node")).distinct().join(seen.nodes(), "node", "left_anti")
    links, met = graph.by_target, seen.nodes()
    links = links.join(met, links["dst"] == met["node"], "left_anti")
    sources = frontier.select(F.col("node").alias("src"))
    if size.fits_broadcast:
        reached = links.join(F.broadcast(sources), "src", "left_semi")
    else:
        reached = join_hot(links, sources, "src", ["dst"], left_counts=graph.links_per_source)
    return reached.select(F.col("dst").alias("node")).distinct()


def reach(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """``node, depth, attempted``: breadth-first traversal of ``edges(src, dst)`` from ``seeds(node)``.

    Depth 0 are the seeds; links found on the last level (``max_depth``, negative for no limit) are listed but not
    attempted. ``max_pages`` limits attempts over all levels, in order of depth and node. Nodes in ``known(node)``
    are never queued. Each level is written to the shared folder, so a lost executor costs one level; what was seen
    stays where it is, so that a level costs as much late as early.
    """
    spark = edges.sparkSession
    seen, graph = _Seen(spark), _Graph(edges)
    seeds = seeds.select("node").distinct()
    if known is not None:
        seen.add(known.select("node").distinct(), _Seen.KNOWN)
        seeds = seeds.join(seen.nodes(), "node", "left_anti")
    depth, size, budget = 0, seen.add(seeds, 0), max_pages
    n_full, cut = 0, None
    while size.rows > 0:
        frontier = seen.level(depth)
        if budget is not None and size.rows > budget:
            cut = frontier.limit(0)
            if budget:
                numbered = number_rows(frontier, [], [F.col("node")], "_number")
                cut = stage(numbered.filter(F.col("_number") <= budget).select("node"), "attempted")
            frontier, size = cut, _Size(budget, size.chars)
        else:
            n_full = depth + 1
        if size.rows == 0:
            break
        if budget is not None:
            budget -= size.rows
        size = seen.add(next_level(graph, frontier, size, seen), depth + 1)
        if depth == max_depth or budget == 0:
            break
        depth += 1
    graph.close()
    rows = seen.close()
    done = rows.filter(F.col("depth") < n_full).withColumn("attempted", F.lit(True))
    rest = rows.filter(F.col("depth") >= n_full)
    if cut is None:
        return done.union(rest.withColumn("attempted", F.lit(False)))
    cut = cut.withColumn("attempted", F.lit(True))
    return done.union(rest.join(cut, "node", "left").withColumn("attempted", F.coalesce("attempted", F.lit(False))))


def reach_recursive(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """``node, depth`` of what ``reach`` attempts within a few levels, as one recursive statement without a driver loop.

    Recursion follows paths: a node is met once per path to it and made distinct at the end only, so this is for small
    depths. Spark ends a statement whose recursion makes more rows than ``spark.sql.cteRecursionRowLimit``.
    """
    if max_depth < 0:
        raise ValueError("recursion needs a depth")
    return edges.sparkSession.sql(
        """
        WITH RECURSIVE walk(node, depth) AS (
          SELECT DISTINCT node, 0L FROM {seeds}
          UNION ALL
          SELECT e.dst, walk.depth + 1 FROM walk JOIN {edges} AS e ON e.src = walk.node WHERE walk.depth < {max_depth}
        )
        SELECT node, min(depth) AS depth FROM walk GROUP BY node
        """,
        seeds=seeds.select("node"), edges=edges.select("src", "dst"), max_depth=max_depth,
    )


def with_status(reached: DataFrame, pages: DataFrame) -> DataFrame:
    """``url, depth, status``: pending if not attempted, visited if an HTML page is there, bad if not."""
    there = html_pages(pages).select(canonical_url(F.col("url")).alias("node")).distinct().withColumn("there", F.lit(True))
    status = (
        F.when(~F.col("attempted"), F.lit("pending")).when(F.col("there").isNull(), F.lit("bad")).otherwise(F.lit("visited"))
    )
    return reached.join(there, "node", "left").select(F.col("node").alias("url"), "depth", status.alias("status"))


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """``url, depth, status`` of every link met from ``seeds(url)`` over a page table.

    Given the ``state`` of an earlier crawl, its pending links and the new seeds start at depth 0; what is visited
    or bad stays as it was and is not tried again.
    """
    edges = stage(link_edges(pages).repartition("src").sortWithinPartitions("src"), "edges")
    start = seeds.select(canonical_url(F.col("url")).alias("node"))
    if state is None:
        return with_status(reach(edges, start, max_depth, max_pages), pages)
    state = stage(state.select("url", "depth", "status"), "state")
    done, waiting = state.filter("status <> 'pending'"), state.filter("status = 'pending'")
    start = start.union(waiting.select(F.col("url").alias("node")))
    reached = reach(edges, start, max_depth, max_pages, known=done.select(F.col("url").alias("node")))
    return done.union(with_status(reached, pages))


def known_links(state: DataFrame) -> DataFrame:
    """All links met that are not bad."""
    return state.filter(F.col("status") != "bad").select("url")


def visited_documents(pages: DataFrame, state: DataFrame) -> DataFrame:
    """The visited pages as documents ``doc_id, text``, ready to be indexed, one per link of the crawl.

    Of page rows whose URLs differ only behind ``?`` or ``#`` the first by URL is taken, since a link is fetched once.
    The id is the URL the page is known by, as of that row.
    """
    visited = state.filter("status = 'visited'").select(F.col("url").alias("_node"))
    pages = html_pages(pages).withColumn("_node", canonical_url(F.col("url"))).join(visited, "_node", "left_semi")
    ids = pages.select(F.col("_node").alias("doc_id"), "url").distinct()
    first = first_per_document(ids, "url").select(F.col("doc_id").alias("_node"), F.col("url").alias("_first"))
    chosen = pages.join(first, "_node").filter(F.col("url") == F.col("_first"))
    return first_per_document(page_documents(chosen, keep=("url",)), "url").select("doc_id", "text")
