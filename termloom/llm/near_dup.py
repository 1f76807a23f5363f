"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union-find groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .files import batch_rows
from .words import Texts, find_words, keyed, mix, sequence_hash, stride, text_groups, window_hashes

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
SLOTS = 128
BAND_SLOTS = 4
# Buckets of many slots bring the most similar documents together first: so many bands make one bucket in each round.
BANDS_PER_BUCKET = (4, 2, 1)
SLOT_BITS = 4
# Of 128 slots cut to 4 bits, 30 differ on average at the least similarity; for long texts as of independent draws, with
# a deviation of 4.8, which leaves a chance of less than one in a million to differ in more than 54.
MAX_DIFFERENT_SLOTS = 54
ELEMENT_BLOCK = 1 << 16
GROUP_BYTES = 1 << 19
# Rows per Arrow batch, which a worker holds whole.
SKETCH_ROWS, PAIR_ROWS = 1000, 250
# Members of a bucket that are paired as rows; larger buckets are cut into cells of so many members and bytes of
# shingles, and two cells at a time are compared as a block inside a task.
PAIRED_MEMBERS, CELL_MEMBERS, CELL_BYTES = 32, 512, 1 << 24
# Shingles that a block is multiplied by at a time.
COLUMNS = 2048
# Edges that one task may turn into groups; more are contracted in rounds.
EDGES_PER_TASK = 200_000

SKETCHES = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, bands array<bigint>, bits array<bigint>"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text end to end (in no particular order within a text), and their bounds.

    A text with fewer words than a shingle has its whole sequence as one, an empty text has none.
    """
    words = find_words(texts, lower=True)
    starts = np.cumsum(words.per_text) - words.per_text
    hashes, first = window_hashes(words, SHINGLE_WORDS)
    found, owner = [hashes], [words.text[first]]
    for size in range(1, SHINGLE_WORDS):
        short = np.flatnonzero(words.per_text == size)
        found.append(sequence_hash([words.hash[starts[short] + k] for k in range(size)]))
        owner.append(short)
    hashes, text = np.concatenate(found), np.concatenate(owner)
    _, first = np.unique(keyed(hashes, text), return_index=True)
    first = first[np.argsort(text[first], kind="stable")]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.bincount(text[first], minlength=len(texts)), out=bounds[1:])
    return hashes[first], bounds


def super_minhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures of many sets at once: ``n_sets`` x ``slots``.

    Every element draws, step by step, the next entry of its own random permutation of the slots (Fisher-Yates) and a
    random fraction; in that slot it offers step + fraction, and the smallest offer stays. An offer of a later step
    never beats one of an earlier step, so a set is finished as soon as all its slots are taken. The step is the high,
    the fraction the low half of a signature value. Each element is thus in a different slot at each step, which is
    what lowers the variance against independent hash functions.
    """
    signature = np.full(n_sets * slots, _UNSET, np.uint64)
    for start in range(0, len(elements), ELEMENT_BLOCK):
        _offer(signature, elements[start : start + ELEMENT_BLOCK], owner[start : start + ELEMENT_BLOCK], slots)
    return signature.reshape(n_sets, slots)


def _offer(signature: np.ndarray, elements: np.ndarray, owner: np.ndarray, slots: int) -> None:
    permutation: np.ndarray | None = None
    for step in range(slots):
        draw = mix(elements + stride(step + 1))
        other = step + ((draw >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            slot = other
        else:
            if permutation is None:
                # The swap of step 0 is made up for here, when most sets are finished already.
                permutation = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                rows = np.arange(len(elements))
                permutation[rows, first_other], permutation[rows, 0] = 0, first_other
            rows = np.arange(len(elements))
            slot = permutation[rows, other].astype(np.int64)
            permutation[rows, other] = permutation[rows, step]
            permutation[rows, step] = slot
        value = (np.uint64(step) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(signature, owner * slots + slot, value)
        # Early stopping: what a set has in all its slots from this or earlier steps can't be improved.
        sets = np.unique(owner)
        worst = signature.reshape(-1, slots)[sets].max(axis=1)
        unfinished = sets[worst >= np.uint64(step + 1) << np.uint64(32)]
        if not len(unfinished):
            return
        stay = np.isin(owner, unfinished)
        elements, owner = elements[stay], owner[stay]
        if permutation is not None:
            permutation = permutation[stay]
        first_other = other[stay] if step == 0 else None


def sketch_texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Set sizes, two halves of a key of the whole set, band hashes and packed signatures, for each run of texts of a column."""
    for texts in text_groups(column, GROUP_BYTES):
        elements, bounds = shingle_sets(texts)
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(texts)), sizes)
        keys = []
        for salt in (1, 2):
            sums = np.zeros(len(elements) + 1, np.uint64)
            np.cumsum(mix(elements + stride(salt)), out=sums[1:])
            keys.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64)).view(np.int64))
        signature = super_minhash(elements, owner, len(texts))
        bands = signature.reshape(len(texts), SLOTS // BAND_SLOTS, BAND_SLOTS)
        hashes = np.zeros(bands.shape[:2], np.uint64) + np.arange(1, bands.shape[1] + 1, dtype=np.uint64)
        for k in range(BAND_SLOTS):
            hashes = mix(hashes * _GOLDEN + bands[:, :, k])
        yield sizes, *keys, hashes.view(np.int64), slot_bits(signature)


def slot_bits(signature: np.ndarray) -> np.ndarray:
    """Signatures cut to ``SLOT_BITS`` hashed bits per slot, packed into 64-bit numbers."""
    per_word = 64 // SLOT_BITS
    few = (mix(signature) >> np.uint64(64 - SLOT_BITS)).reshape(len(signature), -1, per_word)
    shifts = np.arange(per_word, dtype=np.uint64) * np.uint64(SLOT_BITS)
    return np.bitwise_or.reduce(few << shifts, axis=2).view(np.int64)


def different_slots(a: str, b: str) -> F.Column:
    """In how many slots the packed signatures in two columns differ."""
    total = F.lit(0)
    low = F.lit(int("1" * (64 // SLOT_BITS), 16))
    for k in range(SLOTS * SLOT_BITS // 64):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        any_bit = x
        for shift in range(1, SLOT_BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, shift))
        total += F.bit_count(any_bit.bitwiseAND(low))
    return total


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, bands`` of every row; equal sets have equal keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SKETCHES.split(", ")]
        for batch in batches:
            done = 0
            for sizes, key_a, key_b, *tables in sketch_texts(batch.column(1)):
                n = len(sizes)
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, t.size + 1, t.shape[1], dtype=np.int32)), pa.array(t.ravel())
                    )
                    for t in tables
                ]
                ids = batch.column(0).slice(done, n)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (sizes, key_a, key_b)), *lists], names)
                done += n

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(sketch, SKETCHES)


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the candidate pairs ``a, b`` those whose full shingle sets are similar enough."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates")
    texts = stage(texts.join(wanted, "doc_id", "left_semi"), "candidate-texts")
    joined = (
        pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            # Pairs mostly come ordered by b, so that a text with many partners is cut into shingles once.
            done, kept_text, kept_set = 0, None, None
            for texts in text_groups(batch.column(2), GROUP_BYTES):
                sets, bounds = shingle_sets(texts)
                others = batch.column(3).slice(done, len(texts))
                for k in range(len(texts)):
                    if kept_set is None or not others[k].equals(kept_text):
                        (other,) = text_groups(others.slice(k, 1))
                        kept_text, kept_set = others[k], np.sort(shingle_sets(other)[0])
                    own = sets[bounds[k] : bounds[k + 1]]
                    at = np.searchsorted(kept_set, own)
                    at[at == len(kept_set)] = 0
                    common = int((kept_set[at] == own).sum()) if len(kept_set) else 0
                    union = len(own) + len(kept_set) - common
                    linked[done + k] = union > 0 and 100 * common >= SIMILARITY_PERCENT * union
                done += len(texts)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    with batch_rows(joined.sparkSession, PAIR_ROWS):
        return stage(joined.mapInArrow(check, "a bigint, b bigint").distinct(), "verified")


def union_find(edges: Iterator[tuple[np.ndarray, np.ndarray]]) -> dict[int, int]:
    """Smallest member of the group of every node that occurs in the edges."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for left, right in edges:
        for a, b in zip(left.tolist(), right.tolist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def _contract_locally(edges: DataFrame) -> DataFrame:
    """Replace the edges of each task by one edge from every node to the smallest of its group there."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = union_find((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches)
        found = {x: top for x, top in found.items() if x != top}
        columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return edges.select("a", "b").mapInArrow(contract, "a bigint, b bigint").distinct()


def _groups_in_one_task(edges: DataFrame) -> DataFrame:
    """``doc_id, component_id`` of every node of a bounded number of edges."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = union_find((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches)
        columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "component_id"])

    return edges.select("a", "b").coalesce(1).mapInArrow(group, "doc_id bigint, component_id bigint")


def components(edges: DataFrame) -> DataFrame:
    """``doc_id, component_id``: for every node of the edges ``a, b`` the smallest node that it can reach.

    Union-find inside each task first. While more than ``EDGES_PER_TASK`` edges are left, a round points every node to
    its smallest neighbour and joins edges to the nodes pointed at, which leaves fewer nodes; the rest is one task's
    union-find. Each round writes its small tables, so a lost executor costs one round.
    """
    edges = stage(_contract_locally(edges), "edges")
    found = None
    while edges.count() > EDGES_PER_TASK:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        parents = stage(least.select("a", F.least("a", "least").alias("p")), "parents")
        found = _moved(found, parents.withColumnsRenamed({"a": "component_id"}))
        left = edges.join(parents, "a").select(F.col("p").alias("l"), "b")
        right = left.join(parents.withColumnsRenamed({"a": "b", "p": "r"}), "b").filter("l <> r")
        edges = stage(right.select(F.col("l").alias("a"), F.col("r").alias("b")).distinct(), "edges")
    last = _groups_in_one_task(edges)
    return last if found is None else _moved(found, last.select(F.col("doc_id").alias("component_id"), F.col("component_id").alias("p")))


def _moved(found: DataFrame | None, moved: DataFrame) -> DataFrame:
    """Groups after ``moved(component_id, p)``: the nodes of a group follow its representative."""
    if found is None:
        return moved.select(F.col("component_id").alias("doc_id"), F.col("p").alias("component_id"))
    followed = found.join(moved, "component_id", "left")
    return stage(followed.select("doc_id", F.coalesce("p", "component_id").alias("component_id")), "components")


def _buckets(classes: DataFrame, bands: int, groups: DataFrame | None) -> DataFrame:
    """``bucket, doc_id, component_id``: members of buckets of ``bands`` bands that more than one group shares."""
    first = F.sequence(F.lit(0), F.lit(SLOTS // BAND_SLOTS - bands), F.lit(bands))
    hashed = F.transform(first, lambda i: F.xxhash64(F.slice("bands", i + 1, bands))) if bands > 1 else F.col("bands")
    rows = classes.select("doc_id", F.explode(hashed).alias("bucket"))
    if groups is None:
        rows = rows.withColumn("component_id", F.col("doc_id"))
    else:
        rows = rows.join(groups, "doc_id", "left")
        rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    ends = rows.groupBy("bucket").agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
    shared = stage(ends.filter("low < high").select("bucket"), "shared-buckets")
    return stage(rows.join(shared, "bucket", "left_semi"), "buckets")


def _links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """All links between ``classes(doc_id, n_shingles, bands, bits)``, up to ones inside one group.

    The first rounds compare every member of a bucket with one pivot, unless both are in one group by then: from
    buckets of many bands, which only very similar documents share, to buckets of one. Each bucket has a pivot of its
    own, chosen by hash, so that a member of a large group of near copies meets many of them and the group falls
    together. The last round takes all pairs of a bucket that are still in different groups and whose packed signatures
    leave a similarity of 75 % possible (at that similarity the chance to miss is about one in a million), however many
    they are: as rows in small buckets, inside tasks in large ones. The rounds end when no bucket spans two groups.
    """
    tested = links = groups = None
    for number, bands in enumerate([*BANDS_PER_BUCKET, BANDS_PER_BUCKET[-1]]):
        members = _buckets(classes, bands, groups)
        if members.isEmpty():
            continue
        if number < len(BANDS_PER_BUCKET):
            order = F.xxhash64("doc_id", "bucket").alias("order")
            first = F.min(F.struct(order, "doc_id", "component_id")).alias("pivot")
            compared = members.join(stage(members.groupBy("bucket").agg(first), "pivots"), "bucket")
            pairs = compared.filter("component_id <> pivot.component_id")
            pairs = pairs.select(
                F.greatest("doc_id", "pivot.doc_id").alias("a"), F.least("doc_id", "pivot.doc_id").alias("b")
            )
            pairs = _possible(pairs.distinct(), classes)
        else:
            signed = members.join(classes.select("doc_id", "n_shingles", "bits"), "doc_id")
            signed = stage(signed, "signed")
            sizes = signed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
            large = stage(sizes.filter(F.col("n") > PAIRED_MEMBERS), "large-buckets")
            if not large.isEmpty():
                links = _union(links, _block_links(signed, large, docs))
            pairs = _paired(signed.join(large, "bucket", "left_anti"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        links = _union(links, verify(pairs, docs))
        tested = _union(tested, pairs)
        if number < len(BANDS_PER_BUCKET):
            groups = stage(components(links), "groups")
    return links if links is not None else classes.sparkSession.createDataFrame([], "a bigint, b bigint")


def _union(one: DataFrame | None, other: DataFrame) -> DataFrame:
    return other if one is None else one.union(other)


def _paired(signed: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of members of one bucket in different groups that may be similar enough.

    Every member takes its signature along, so that impossible pairs end inside the join.
    """
    other = signed.withColumnsRenamed({"doc_id": "b", "component_id": "other_id", "n_shingles": "n_b", "bits": "bits_b"})
    possible = (
        (F.col("doc_id") > F.col("b"))
        & (F.col("component_id") != F.col("other_id"))
        & _sizes_fit(F.col("n_shingles"), F.col("n_b"))
        & (different_slots("bits", "bits_b") <= MAX_DIFFERENT_SLOTS)
    )
    left = signed.withColumnRenamed("bucket", "own_bucket")
    pairs = left.join(other, (F.col("own_bucket") == F.col("bucket")) & possible)
    return pairs.select(F.col("doc_id").alias("a"), "b").distinct()


def _block_links(signed: DataFrame, large: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between the groups of the members of large buckets; what joins the same groups again is left out.

    Members of one family of similar texts share many large buckets, so each is compared in its largest bucket first
    of all, and in the others only where members of several largest buckets meet. A bucket is cut into cells, and any
    two of its cells make a block that one task compares as a whole, so there is a row per member and block, never
    one per pair. The full shingle sets go along, so links are confirmed on the spot.
    """
    rows = signed.join(large, "bucket")
    size = F.struct("n", "bucket")
    main = rows.groupBy("doc_id").agg(F.max(size)["bucket"].alias("main"))
    rows = stage(rows.join(main, "doc_id"), "large-members")
    several = rows.groupBy("bucket").agg(F.min("main").alias("low"), F.max("main").alias("high")).filter("low < high")
    needed = rows.join(several.select("bucket", F.lit(True).alias("several")), "bucket", "left")
    needed = needed.filter((F.col("main") == F.col("bucket")) | F.col("several"))
    cells = F.greatest(F.ceil(F.col("n") / CELL_MEMBERS), F.ceil(F.col("total") * 8 / CELL_BYTES)).cast("int")
    needed = needed.withColumn("cells", cells).withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int"))
    needed = needed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    block = F.struct("bucket", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"))
    needed = needed.select(block.alias("block"), "cell", "doc_id", "component_id", "n_shingles", "bits")
    wanted = stage(main.select("doc_id"), "large-ids")
    with batch_rows(docs.sparkSession, SKETCH_ROWS):
        sets = stage(_stored_sets(docs, wanted), "sets")
    with batch_rows(docs.sparkSession, PAIR_ROWS):
        return stage(needed.join(sets, "doc_id").groupBy("block").applyInArrow(_compare_block, "a bigint, b bigint"), "block-links")


def _stored_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the shingle hashes of the wanted documents, a row for each text of rows that share an id."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(wanted, "doc_id", "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_groups(batch.column(1), GROUP_BYTES):
                hashes, bounds = shingle_sets(texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), lists], ["doc_id", "shingles"])
                done += len(texts)

    return texts.mapInArrow(cut, "doc_id bigint, shingles array<bigint>").distinct()


def _compare_block(block: pa.Table) -> pa.Table:
    """Links between the groups of a block ``block, cell, doc_id, component_id, n_shingles, bits, shingles``."""
    ids, groups, sizes, cells = (block.column(c).to_numpy() for c in ("doc_id", "component_id", "n_shingles", "cell"))
    bits = block.column("bits").combine_chunks().flatten().to_numpy().reshape(len(ids), -1).view(np.uint64)
    possible = _possible_in_block(groups, sizes, bits)
    if len(set(cells.tolist())) > 1:
        # What is in one cell meets in the block of that cell.
        possible &= cells[:, None] != cells
    some = np.flatnonzero(possible.any(axis=0) | possible.any(axis=1))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    edges = []
    if len(some):
        sets = block.column("shingles").combine_chunks().take(pa.array(some))
        lengths = sets.value_lengths().to_numpy().astype(np.int64)
        common = common_counts(sets.flatten().to_numpy(), np.repeat(np.arange(len(some)), lengths), len(some))
        union = lengths[:, None] + lengths - common
        linked = possible[np.ix_(some, some)] & (100 * common >= SIMILARITY_PERCENT * union)
        for one, other in zip(*(some[k].tolist() for k in np.nonzero(linked))):
            x, y = root(int(groups[one])), root(int(groups[other]))
            if x != y:
                parent[x] = y
                edges.append((ids[one], ids[other]))
    found = np.sort(np.array(edges, np.int64).reshape(-1, 2), axis=1)
    return pa.table({"a": found[:, 1], "b": found[:, 0]})


def _possible_in_block(groups: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which pairs, the first before the second, are of different groups and may be similar enough."""
    low = np.uint64(int("1" * (64 // SLOT_BITS), 16))
    different = np.zeros((len(groups), len(groups)), np.int16)
    for word in bits.T:
        x = word[:, None] ^ word
        any_bit = x
        for shift in range(1, SLOT_BITS):
            any_bit = any_bit | (x >> np.uint64(shift))
        different += np.bitwise_count(any_bit & low).astype(np.int16)
    fits = 100 * np.minimum(sizes[:, None], sizes) >= SIMILARITY_PERCENT * np.maximum(sizes[:, None], sizes)
    return np.triu((groups[:, None] != groups) & fits & (different <= MAX_DIFFERENT_SLOTS), 1)


def common_counts(shingles: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many shingles any two of ``n`` sets share, some columns of their membership matrix at a time."""
    values, number = np.unique(shingles, return_inverse=True)
    shared = np.bincount(number, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    kept = shared[number]
    column, owner = column[number[kept]], owner[kept]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _sizes_fit(a: F.Column, b: F.Column) -> F.Column:
    """Whether two set sizes allow the similarity at all."""
    return 100 * F.least(a, b) >= SIMILARITY_PERCENT * F.greatest(a, b)


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidate pairs ``a, b`` whose set sizes and packed signatures allow the similarity."""
    for side in "ab":
        own = {"doc_id": side, "n_shingles": f"n_{side}", "bits": f"bits_{side}"}
        pairs = pairs.join(classes.select(*own).withColumnsRenamed(own), side)
    close = different_slots("bits_a", "bits_b") <= MAX_DIFFERENT_SLOTS
    return pairs.filter(_sizes_fit(F.col("n_a"), F.col("n_b")) & close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Documents with equal sets are one class, known by its smallest id; only classes are banded and compared. Empty and
    null texts are linked with nothing. Rows with a null id have a null ``component_id``, are linked with nothing and
    kept. Rows that share an id count as one document and stand or fall together. An empty table gives no rows. Texts of
    any length are cut into shingles whole, a long one by itself. Other columns are left alone whatever their names.
    """
    with batch_rows(docs.sparkSession, SKETCH_ROWS):
        found = stage(sketches(docs), "sketches")
    filled = found.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(
        filled.groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")),
        "classes",
    )
    firsts = classes.select(F.col("class_id").alias("doc_id"), "key_a", "key_b")
    banded = filled.join(firsts, ["doc_id", "key_a", "key_b"], "left_semi")
    # Only classes that share a bucket of one band with another can share a larger one.
    near = _buckets(banded, BANDS_PER_BUCKET[-1], None).select("doc_id").distinct()
    signed = banded.join(stage(near, "near"), "doc_id", "left_semi")
    signed = stage(signed.select("doc_id", "n_shingles", "bands", "bits"), "signed")
    links = _links(signed, docs)
    groups = stage(components(links), "groups").withColumnsRenamed({"doc_id": "class_id"})
    copies = stage(classes.filter("n > 1").drop("n"), "copies")
    return (
        found.select("doc_id", "n_shingles", "key_a", "key_b")
        .join(copies, ["key_a", "key_b", "n_shingles"], "left")
        .withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")))
        .join(groups, "class_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "class_id"))
        .select(
            "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        )
    )
