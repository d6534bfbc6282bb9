"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on the full shingle sets.

Texts with equal sets are one class from the start. The signatures of the classes are sorted in ``TREES`` orders, each
beginning at another column. Two classes are candidates if they stand near each other in some order and share its first
``DEPTH`` columns; where a region of equal beginnings holds more than ``NEAR`` classes, sorting by the further columns
puts those next to each other that share the longest prefix, so the depth adapts to the crowd. Candidates whose
signatures differ too much to reach the threshold (five standard deviations) are dropped, the others are confirmed.

Every component needs only as many confirmed links as hold it together. The first pass confirms for each class its most
alike and some random candidates. The second confirms what is left between different components, and, for the crowded
regions, all pairs across components, in blocks of bounded size, so no link between different texts hides in a crowd.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.components import components
from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.text import buffers, chunks, mix, random_words, shingles, words

TREES, DEPTH, DEEPER = 24, 4, 4  # orders; columns that candidates share; further columns of the sort key
COLUMNS = TREES * DEPTH
NEAR = 4  # places looked ahead in an order
BLOCK = 2048  # classes of a crowded region compared at a time
ALIKE, RANDOM = 2, 2  # candidates of a class confirmed in the first pass
PERCENT = 80

_FACTORS = (random_words(21, COLUMNS) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (random_words(22, COLUMNS) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; null and texts without words have none."""
    data, offsets = buffers(column)
    found = words(data, offsets)
    hashes, bounds = shingles(found.hashes, found.bounds, size)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit values per non-empty set; equal columns have about the sets' Jaccard similarity."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((COLUMNS, len(sets)), np.uint32)
    for k in range(COLUMNS):
        out[k] = np.minimum.reduceat(flat * _FACTORS[k] + _SHIFTS[k], starts)
    return (out * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16).T


SIGNED = "doc_id long, n_shingles long, low long, high long, signature binary"


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, set size, 128 bits of the set and its signature (null for empty sets), for every row and whole text."""
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            sets = shingle_sets(piece.column(1), size)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            low, high = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            signatures: list[bytes | None] = [None] * len(sets)
            if len(full):
                own = [sets[i] for i in full]
                low[full] = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in own]
                high[full] = [int(mix(s ^ np.uint64(99)).sum(dtype=np.uint64).view(np.int64)) for s in own]
                for i, row in zip(full, minhash(own)):
                    signatures[i] = row.tobytes()
            columns = [piece.column(0), pa.array(sizes), pa.array(low), pa.array(high), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "low", "high", "signature"])

    return rows.mapInArrow(run, SIGNED)


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and order: the order, the columns candidates share, and the further ones, as numbers."""
    names = ["tree", "top", "deep", "node"]
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        signatures = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(n, COLUMNS).astype(np.uint64)
        for tree in range(TREES):
            at = (tree * DEPTH + np.arange(DEPTH + DEEPER)) % COLUMNS
            top, deep = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            for k in at[:DEPTH]:
                top = top << np.uint64(16) | signatures[:, k]
            for k in at[DEPTH:]:
                deep = deep << np.uint64(16) | signatures[:, k]
            columns = [pa.array(np.full(n, tree, np.int32)), pa.array(top.view(np.int64)), pa.array(deep.view(np.int64)), batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns, names)


FOUND = "a long, b long, tree int, top long"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over a sorted partition: pairs (a, b) near each other in a region, and members (a, null, tree, top) of crowds."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    tree, top, node = (np.concatenate([b.column(k).to_numpy() for b in parts]) for k in (0, 1, 3))
    change = np.flatnonzero((tree[1:] != tree[:-1]) | (top[1:] != top[:-1])) + 1
    starts = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([starts, [len(node)]]))
    region = np.repeat(np.arange(len(starts)), sizes)
    firsts, seconds = [], []
    for ahead in range(1, min(NEAR, len(node) - 1) + 1):
        same = np.flatnonzero(region[ahead:] == region[:-ahead])
        firsts.append(node[same])
        seconds.append(node[same + ahead])
    if firsts:
        a, b = np.concatenate(firsts), np.concatenate(seconds)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)  # orders of a partition repeat pairs
        a, b = both[:, both[0] < both[1]]
        none = pa.nulls(len(a))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none.cast(pa.int32()), none.cast(pa.int64())], ["a", "b", "tree", "top"])
    large = sizes > NEAR
    large[[0, -1]] = True  # these may go on in the partitions before and after
    crowd = np.repeat(large, sizes)
    if crowd.any():
        none = pa.nulls(int(crowd.sum())).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(node[crowd]), none, pa.array(tree[crowd]), pa.array(top[crowd])], ["a", "b", "tree", "top"])


def least_equal(percent: int) -> int:
    """Equal columns below which a pair at the threshold is found once in millions."""
    p = percent / 100
    return int(COLUMNS * p - 5 * (COLUMNS * p * (1 - p)) ** 0.5)


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, equal) of the pairs whose signatures agree in enough columns."""
    least = least_equal(percent)
    own = pairs.join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
    own = own.join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sa, sb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, COLUMNS) for k in (2, 3))
            equal = (sa == sb).sum(1)
            good = np.flatnonzero(equal >= least)
            kept_rows = batch.take(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept_rows.column(0), kept_rows.column(1), pa.array(equal[good].astype(np.int32))], ["a", "b", "equal"])

    return own.mapInArrow(run, "a long, b long, equal int")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                if _alike_enough(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), percent):
                    good.append(i)
            found = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], ["a", "b"])

    return kept(both.mapInArrow(run, "a long, b long"), "links")


def _sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the full sets of the needed classes, from the texts of their first documents."""
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            bodies = [s.tobytes() for s in shingle_sets(piece.column(1), size)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(bodies, pa.binary())], ["node", "shingles"])

    return kept(rows.join(needed, "node", "left_semi").mapInArrow(run, "node long, shingles binary"), "sets")


def _agreeing(key, table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a block pair and, for each, the others of another component whose signatures agree enough.

    Each pair has an end outside the largest component, so only such rows are gone through. Two classes that share the
    beginnings of several orders meet in the first of these.
    """
    component, own = table.column("component").to_numpy(), table.column("own").to_numpy()
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, COLUMNS)
    tree, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
    values, counts = np.unique(component, return_counts=True)
    for row in np.flatnonzero(component != values[counts.argmax()]):
        good = (component != component[row]) & ((signatures == signatures[row]).sum(1) >= least_equal(percent))
        if i != j:
            good &= own != own[row]
        others = np.flatnonzero(good)
        shared = (signatures[others, : tree * DEPTH] == signatures[row, : tree * DEPTH]).reshape(len(others), tree, DEPTH)
        others = others[~shared.all(2).any(1)]
        if len(others):
            yield int(row), others


def _alike_enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(x) < percent * len(y):
        return False
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _across(crowds: DataFrame, found: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) in crowded regions between different components.

    A region is cut into blocks, and every two blocks meet in a group of their own, which bounds what a task holds. They
    meet twice: with their signatures, to tell who has a partner that agrees, and, those who have, with their full sets.
    No pair leaves a group unless confirmed, and no two components are linked twice in it.
    """
    members = crowds.join(found.withColumnRenamed("node", "a"), "a", "left")
    members = members.select("tree", "top", F.col("a").alias("node"), F.coalesce("component", "a").alias("component"))
    key = ["tree", "top"]
    regions = members.groupBy(*key).agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    regions = regions.filter("x < y").select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(regions, key).join(nodes, "node")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    columns = ["tree", "top", "i", "j", "node", "component", "own", "signature"]

    def agreeing(key, table):
        marked = np.zeros(len(table), bool)
        for row, others in _agreeing(key, table, percent):
            marked[row] = True
            marked[others] = True
        return table.select(columns).filter(pa.array(marked))

    def confirmed(key, table):
        node, component = table.column("node").to_pylist(), table.column("component").to_pylist()
        bodies = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("shingles")]
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        links = []
        for row, others in _agreeing(key, table, percent):
            for other in others:
                x, y = root(component[row]), root(component[other])
                if x != y and _alike_enough(bodies[row], bodies[other], percent):
                    up[x] = y
                    links.append((node[row], node[other]))
        return pa.table({"a": pa.array([min(x) for x in links], pa.int64()), "b": pa.array([max(x) for x in links], pa.int64())})

    block = ["tree", "top", "i", "j"]
    kinds = "tree int, top long, i int, j int, node long, component long, own int, signature binary"
    met = dealt.select(columns).groupBy(*block).applyInArrow(agreeing, kinds)
    return met.join(sets, "node").groupBy(*block).applyInArrow(confirmed, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words are what stands between ASCII white space, A-Z lower-cased; a set holds the distinct runs of ``size`` words, or
    the whole sequence where there are fewer. Documents are linked if 100 * intersection >= percent * union. component_id
    is the smallest doc_id reachable; kept tells whether it is the row's own. Null, empty and blank texts have an empty
    set and are linked with nothing. Rows that share a doc_id are one document with several texts. A row without doc_id
    joins the component of its equals, starts no link by itself, and is kept only if it has no equals with a doc_id.
    Columns other than doc_id and text are not looked at.
    """
    rows = kept(signed(docs, size), "signatures")
    full = rows.filter("n_shingles > 0")
    key = ["low", "high", "n_shingles"]
    classes = kept(full.groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "classes")
    nodes = classes.filter("node IS NOT NULL").select("node", "signature")
    ordered = nodes.mapInArrow(_orders, "tree int, top long, deep long, node long")
    ordered = ordered.repartitionByRange("tree", "top", "deep", "node").sortWithinPartitions("tree", "top", "deep", "node")
    found = kept(ordered.mapInArrow(_neighbours, FOUND), "neighbours")
    crowds = found.filter("b IS NULL").select("a", "tree", "top")
    pairs = kept(_alike(found.filter("b IS NOT NULL").select("a", "b").distinct(), nodes, percent), "candidates")
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowds.select("a")).distinct()
    sets = _sets(docs, needed, size)

    ends = pairs.union(pairs.select("b", "a", "equal"))
    by = Window.partitionBy("a")
    ends = ends.withColumn("place", F.row_number().over(by.orderBy(F.desc("equal"), "b")))
    ends = ends.withColumn("other", F.row_number().over(by.orderBy(F.xxhash64("a", "b"))))
    chosen = ends.filter((F.col("place") <= ALIKE) | (F.col("other") <= RANDOM))
    chosen = kept(chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "first-pairs")
    links = _confirmed(chosen, sets, percent)
    group = kept(components(links), "components")

    side = lambda c: group.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    rest = pairs.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
    rest = rest.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    more = _confirmed(rest.join(chosen, ["a", "b"], "left_anti"), sets, percent)
    across = kept(_across(crowds, group, nodes, sets, percent), "links")
    if not (more.isEmpty() and across.isEmpty()):
        group = components(links.union(more).union(across))
    named = classes.join(group, "node", "left").select(*key, F.coalesce("component", "node").alias("component"))
    done = rows.join(named, key, "left")
    component = F.coalesce("component", "doc_id")
    return done.select(
        "doc_id",
        F.col("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )
