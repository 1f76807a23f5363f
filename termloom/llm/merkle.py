"""Merkle manifest of a table: one tree per source, one tree over the sources, and a proof for every row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_CHARS, fits_broadcast, join_small_or_hot
from ..operators.numbering import number_rows
from ..session import stage

FANOUT = 16
# Characters of one digest and of one segment of a proof, the latter with room for its frame.
DIGEST_CHARS, STEP_CHARS = 64, 1100
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = ""  # name of the tree over the sources; those of sources are at least one letter long
TOP_HEIGHT = 1 << 20

RUNS = (
    "node string, hashed boolean, lone boolean, "
    "members array<struct<digest: string, doc_id: bigint, changed: string, leaf: boolean>>"
)
PATHS = "node string, subroot string, steps array<struct<before: string, after: string>>"


@dataclass(frozen=True)
class Manifest:
    """A hashed table.

    ``runs(node, hashed, lone, members)``: the lowest run that each leaf is hashed in, under the name of the node
    above it. A member is a struct of its digest and, for a leaf, ``doc_id`` and ``changed``, the digest of a changed
    copy of the row. ``lone`` runs are those of the top tree, whose leaves are the only ones of their source;
    ``hashed`` is false only for the run of a table with one row, whose digest is the root itself.
    ``paths(node, subroot, steps)``: for each node above the leaves the digest of its source's tree (null if that is
    the root) and its siblings on the way to the root, lowest first, as the joined digests before and after each node.
    ``root``: the digest of the whole table, None for an empty one.
    """

    runs: DataFrame
    paths: DataFrame
    root: str | None


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def row_digest(fields: list[Column]) -> Column:
    """Digest of one row: of every field ``-`` if it is null, else its length in UTF-8 bytes, a colon and its value."""
    written = [c.cast("string") for c in fields]
    parts = [F.concat(F.octet_length(c).cast("string"), F.lit(":"), c) for c in written]
    return digest(F.concat(*[F.coalesce(part, F.lit("-")) for part in parts]))


def tree_of(source: Column) -> Column:
    """Name of the tree of a source; null comes first, the rest in the order of their bytes."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("-"))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``tree, doc_id, digest, changed`` of ``docs(doc_id, source, lang, n_chars, text)``.

    ``changed`` is the digest of the row with A-Z of its text in lower case where ``tampered`` is true, else null.
    """
    fields = [F.col("doc_id").cast("bigint"), *[F.col(c) for c in ("source", "lang", "n_chars", "text")]]
    lowered = [*fields[:-1], F.translate("text", UPPER, LOWER)]
    return docs.select(
        tree_of(F.col("source").cast("string")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        row_digest(fields).alias("digest"),
        F.when(tampered, row_digest(lowered)).alias("changed"),
    )


def _name(level: int, idx: Column) -> Column:
    return F.concat_ws(":", F.lit(str(level)), idx.cast("string"), F.col("tree"))


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """``node, tree, idx, n, members, digest``: each run of ``FANOUT`` nodes, under the node above; ``n`` counts those."""
    member = F.struct("idx", "node", "digest", "doc_id", "changed", "leaf", "subroot")
    runs = nodes.groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
        F.sort_array(F.collect_list(member)).alias("members"), F.max("n").alias("n")
    )
    return runs.select(
        _name(level + 1, F.col("idx")).alias("node"),
        "tree",
        "idx",
        F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
        "members",
        digest(F.array_join("members.digest", "")).alias("digest"),
    )


def _grow(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Hash the nodes of all trees level by level; the last node of each tree, and the runs of every level.

    Each level is staged, so a lost executor costs one level. A run has at most ``FANOUT`` members, however many
    nodes its tree has.
    """
    none = F.lit(None).cast("string")
    last, levels = [], []
    while True:
        last.append(nodes.filter("n = 1"))
        growing = nodes.filter("n > 1")
        if growing.isEmpty():
            return reduce(DataFrame.unionByName, last), levels
        levels.append(stage(_runs(growing, len(levels)), f"{name}-runs"))
        nodes = levels[-1].select(
            "tree", "idx", "n", "node", "digest", F.lit(None).cast("bigint").alias("doc_id"), none.alias("changed"),
            F.lit(False).alias("leaf"), none.alias("subroot"),
        )


def manifest(found: DataFrame) -> Manifest:
    """Hash :func:`leaves`; the leaves of a tree ascend by ``doc_id``, null first, equal ids by digest.

    They are numbered over a range-partitioned sort, so a source with a third of all rows is spread over the tasks
    like any other. The trees of all sources grow together, then the tree over their roots.
    """
    spark = found.sparkSession
    found = stage(found, "leaves")
    sizes = found.groupBy("tree").agg(F.count("*").alias("n"))
    numbered = number_rows(found, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("changed")], "idx")
    sized = join_small_or_hot(numbered.withColumn("idx", F.col("idx") - 1), stage(sizes, "tree-sizes"), "tree", ["idx"])
    nodes = sized.withColumns(
        {"node": _name(0, F.col("idx")), "leaf": F.lit(True), "subroot": F.lit(None).cast("string")}
    )
    subroots, levels = _grow(nodes, "source")
    subroots = subroots.drop("idx", "n").withColumn("subroot", F.col("digest"))
    top = stage(number_rows(subroots, [], [F.col("tree")], "idx"), "subroots")
    n_sources = top.count()
    if not n_sources:
        return Manifest(spark.createDataFrame([], RUNS), spark.createDataFrame([], PATHS), None)
    top = top.withColumns({"tree": F.lit(TOP), "idx": F.col("idx") - 1, "n": F.lit(n_sources).cast("bigint")})
    last, top_levels = _grow(top, "top")
    root = last.select("node", "digest", "doc_id", "changed", "leaf", "subroot").first()
    return Manifest(_first_runs(spark, levels, top_levels, root), _paths(spark, levels, top_levels, root), root["digest"])


def _first_runs(spark: SparkSession, levels: list[DataFrame], top_levels: list[DataFrame], root: Row) -> DataFrame:
    """The runs that hold leaves: the lowest of the sources and, for sources with one row, the lowest at the top."""
    if root["leaf"]:
        member = (root["digest"], root["doc_id"], root["changed"], True)
        return spark.createDataFrame([(root["node"], False, True, [member])], RUNS)
    with_leaves = []
    for runs, lone in [(r, False) for r in levels[:1]] + [(r, True) for r in top_levels[:1]]:
        kept = F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in ("digest", "doc_id", "changed", "leaf")]))
        runs = runs.filter(F.exists("members", lambda m: m["leaf"]))
        with_leaves.append(runs.select("node", F.lit(True).alias("hashed"), F.lit(lone).alias("lone"), kept.alias("members")))
    return reduce(DataFrame.unionByName, with_leaves)


def _step(at: Column) -> Column:
    """The siblings of the member at a place of a run, joined before and after it."""
    every = F.array_join("members.digest", "")
    return F.struct(
        F.substr(every, F.lit(1), at * DIGEST_CHARS).alias("before"),
        F.substr(every, (at + 1) * DIGEST_CHARS + 1, F.lit(FANOUT * DIGEST_CHARS)).alias("after"),
    )


def _pointers(levels: list[DataFrame], top_levels: list[DataFrame]) -> list[DataFrame]:
    """``node, up, subroot, steps, height`` of every node between the leaves and the root."""
    found = []
    for number, runs in enumerate([*levels, *top_levels]):
        at_top = number - len(levels)
        # Leaves get their siblings from their own run later; they are the only members of the lowest runs.
        if number == 0 and levels:
            continue
        one = runs.select(F.col("node").alias("up"), "members", F.posexplode("members").alias("at", "member"))
        own_level = F.split_part(F.col("member.node"), F.lit(":"), F.lit(1)).cast("int")
        found.append(
            one.filter("not member.leaf").select(
                F.col("member.node").alias("node"),
                "up",
                F.col("member.subroot").alias("subroot"),
                F.array(_step(F.col("at"))).alias("steps"),
                (F.lit(TOP_HEIGHT) if at_top > 0 else own_level).alias("height"),
            )
        )
    return found


def _paths(spark: SparkSession, levels: list[DataFrame], top_levels: list[DataFrame], root: Row) -> DataFrame:
    """``node, subroot, steps`` of every node above the leaves, by pointer jumping.

    Each node starts with a pointer to the node above it and one segment, its siblings there. In a round the table is
    joined with itself: a node takes over the pointer of the node that it points at and appends the segments of that
    one, which doubles its distance. Nodes that point at the root are done and not joined again. Of the side pointed
    at only nodes as high as the distance of the round are read, which are a power of 16 fewer each time; they are
    broadcast while they are few, beyond that a node that many point at is cut into cells.
    """
    end = spark.createDataFrame([(root["node"], root["subroot"], [])], PATHS)
    pointers = _pointers(levels, top_levels)
    if not pointers:
        return end
    open_ = stage(reduce(DataFrame.unionByName, pointers), "pointers")
    distance, longest, done = 1, len(levels) + len(top_levels) - 1, []
    at_root = F.col("up") == root["node"]
    while True:
        done.append(open_.filter(at_root))
        if distance >= longest:
            break
        ahead = reduce(DataFrame.unionByName, [*done, open_.filter(~at_root)]).filter(F.col("height") > distance)
        ahead = ahead.select(
            F.col("node").alias("up"), F.col("up").alias("far"), F.col("subroot").alias("far_subroot"),
            F.col("steps").alias("far_steps"),
        )
        few = fits_broadcast(ahead.select("up"), rows=BROADCAST_CHARS // (STEP_CHARS * distance))
        joined = join_small_or_hot(open_.filter(~at_root), ahead, "up", ["node"], small=few)
        open_ = stage(
            joined.select(
                "node", F.col("far").alias("up"), F.coalesce("subroot", "far_subroot").alias("subroot"),
                F.concat("steps", "far_steps").alias("steps"), "height",
            ),
            "pointers",
        )
        distance *= 2
    return reduce(DataFrame.unionByName, [d.select("node", "subroot", "steps") for d in done] + [end])


def proofs(made: Manifest) -> DataFrame:
    """``doc_id, leaf, changed, subroot, root, steps`` of every leaf of a manifest.

    ``steps`` are the siblings from the leaf to the root, lowest first: structs of the joined digests ``before`` and
    ``after`` the node. What a run's leaves have in common reaches them as one row per run.
    """
    joined = made.runs.join(made.paths, "node")
    own = F.when(F.col("hashed"), F.array(_step(F.col("at")))).otherwise(F.slice("steps", 1, 0))
    one = joined.select("*", F.posexplode("members").alias("at", "member")).filter("member.leaf")
    root = F.lit(made.root).cast("string")
    return one.select(
        F.col("member.doc_id").alias("doc_id"),
        F.col("member.digest").alias("leaf"),
        F.col("member.changed").alias("changed"),
        F.when(F.col("lone"), F.col("member.digest")).otherwise(F.coalesce("subroot", root)).alias("subroot"),
        root.alias("root"),
        F.concat(own, "steps").alias("steps"),
    )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(steps, leaf, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def siblings(steps: Column) -> Column:
    """All digests of a proof joined, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["before"], step["after"])), "")


def manifest_proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """Hash ``docs(doc_id, source, lang, n_chars, text)`` and check each row, changed where ``tampered``, by its proof.

    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per row of the table.

    Nulls in any column are hashed as such; a null source is a source of its own, a null id comes first. Texts of any
    length are hashed whole, by Spark's own function. Rows that are equal, or share an id, are a leaf each. An empty
    table gives no rows and has no root. Other columns are left alone whatever their names.
    """
    found = proofs(manifest(leaves(docs, tampered)))
    found = found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("steps")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings(F.col("steps"))).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
