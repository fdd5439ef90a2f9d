"""SimHash near-duplicates through vantage-point trees.

A fingerprint has 64 bits; a bit is 1 if it is set in over half the XXH64
hashes of the text's word shingles.  Fingerprints that differ in at most
``max_bits`` bits link; groups are the connected components of the links.

Equal fingerprints become one row first.  A small vantage-point tree, grown
from a bounded sample, deals the distinct fingerprints to shards by their
Hamming distance to its vantage points.  A fingerprint that lies within
``max_bits`` of a boundary also visits the shards on the other side, as the
triangle inequality allows a partner there; so each pair meets in the home
shard of one of the two and no link is lost.  Within a shard the same split goes on until a
leaf is small.  A shard answers with a spanning forest, one row per linked
fingerprint and never all pairs; crowded balls that no split thins out are
searched by enumerating the neighbours of each fingerprint instead.

Defined results: a NULL or empty text, or one without words, has fingerprint
zero and links like any other; fewer words than the shingle length make one
shingle; repeated rows share a fingerprint; a NULL id is never the smallest
unless all ids of the component are NULL; an empty table gives no rows; other
columns of the input are passed over.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import join_keys, landed, map_arrow, release_memory, small_batches, text_or_empty

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Distinct fingerprints a shard should hold, and the bound of the sample the tree is grown from.
SHARD_POINTS = 16_384
SAMPLE_POINTS = 16_384
LEAF_POINTS = 128
#: Points of a node that no split thins out, from which neighbours are enumerated.
CROWD_POINTS = 8_192


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text.  ``bytes.lower`` and ``bytes.split``
    touch A-Z and ASCII white space only, as the definition asks."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    whole, n = b" ".join(words), max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    end = np.cumsum(size) - 1
    begin = end - size + 1
    last = end[-n:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65_536):
        hashes = [digest(whole[a:b], SEED)
                  for a, b in zip(begin[lo:min(n, lo + 65_536)].tolist(), last[lo:lo + 65_536].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed long; the hash of
    the whole text tells rows of one id apart."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def hashed(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column("text").to_pylist()),
                              dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"])
            del batch
        release_memory()

    return map_arrow(rows, hashed, f"doc_id {kind}, text_hash long, fp long")


def _distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _split(points: np.ndarray, max_bits: int, rng) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that put the fewest points near the boundary,
    among a few candidates; None if all points stay on one side."""
    best = None
    for vantage in points[rng.integers(0, len(points), 6)]:
        d = _distance(points, vantage)
        radius = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
        for r in (radius, radius - 1):
            inside = int((d <= r).sum())
            if 0 < inside < len(points):
                visits = int((d <= r + max_bits).sum() + (d > r - max_bits).sum())
                cost = visits * max(inside, len(points) - inside)
                if best is None or cost < best[0]:
                    best = (cost, vantage, r)
    return best and best[1:]


def grow_tree(sample: np.ndarray, depth: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a full binary tree, in heap order."""
    rng = np.random.default_rng(SEED)
    vantage, radius = np.zeros(2**depth - 1, dtype=np.uint64), np.full(2**depth - 1, 32, dtype=np.int16)
    held = {0: np.unique(sample)}
    for node in range(2**depth - 1):
        points = held.pop(node, np.zeros(0, dtype=np.uint64))
        if len(points) > 1 and (found := _split(points, max_bits, rng)):
            vantage[node], radius[node] = found
        inside = _distance(points, vantage[node]) <= radius[node]
        held[2 * node + 1], held[2 * node + 2] = points[inside], points[~inside]
    return vantage, radius


def visits(fps: np.ndarray, tree: tuple[np.ndarray, np.ndarray], max_bits: int):
    """(index, shard, home) of every shard a fingerprint must visit: its own
    and those after it that may hold a partner."""
    vantage, radius = tree
    at, node = np.arange(len(fps)), np.zeros(len(fps), dtype=np.int64)
    home = np.ones(len(fps), dtype=bool)
    while len(node) and node[0] < len(vantage):  # all entries stand on the same level
        d, r = _distance(fps[at], vantage[node]), radius[node]
        left, right = d <= r + max_bits, d > r - max_bits
        at, home, node = (np.concatenate([at[left], at[right]]),
                          np.concatenate([(home & (d <= r))[left], (home & (d > r))[right]]),
                          np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]))
    own = np.zeros(len(fps), dtype=np.int64)
    own[at[home]] = node[home]
    later = node >= own[at]  # the pair meets where the later of the two homes is
    return at[later], node[later] - len(vantage), home[later]


class Forest:
    """Least-index labels under unions given as arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.label[a] != self.label[b]
        if new.any():
            self.held.append((a[new], b[new]))
            self.n_held += int(new.sum())
            if self.n_held > 1_000_000:
                self.settle()

    def settle(self) -> np.ndarray:
        if self.held:
            a, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
            label = self.label
            while len(a):
                la, lb = label[a], label[b]
                low = np.minimum(la, lb)
                np.minimum.at(label, la, low)
                np.minimum.at(label, lb, low)
                while not np.array_equal(up := label[label], label):
                    label[:] = up
                open_ = label[a] != label[b]
                a, b = a[open_], b[open_]
            self.held, self.n_held = [], 0
        return self.label


def _masks(max_bits: int) -> np.ndarray:
    """All non-zero bit patterns of at most ``max_bits`` bits."""
    level = grown = np.zeros(1, dtype=np.uint64)
    ones = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(max_bits):
        level = np.unique(level[:, None] ^ ones[None, :])
        grown = np.union1d(grown, level)
    return grown[grown != 0]


def link(fps: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Least-index label of each of the distinct ``fps``; every pair of a home
    point and any other fingerprint within ``max_bits`` bits is linked."""
    forest, rng = Forest(len(fps)), np.random.default_rng(SEED)
    todo = [(np.flatnonzero(home), np.arange(len(fps)))]
    while todo:
        points, queries = todo.pop()
        if len(points) <= LEAF_POINTS or not (found := _split(fps[points], max_bits, rng)):
            for lo in range(0, len(queries), 16_384):
                some = queries[lo:lo + 16_384]
                for k in range(0, len(points), LEAF_POINTS):
                    near = points[k:k + LEAF_POINTS]
                    i, j = np.nonzero(_distance(fps[near][:, None], fps[some][None, :]) <= max_bits)
                    forest.add(near[i], some[j])
            continue
        vantage, r = found
        dp, dq = _distance(fps[points], vantage), _distance(fps[queries], vantage)
        left, right = queries[dq <= r + max_bits], queries[dq > r - max_bits]
        if len(points) > CROWD_POINTS and len(left) + len(right) > 1.8 * len(queries):
            order = points[np.argsort(fps[points])]
            known = fps[order]
            for mask in _masks(max_bits):
                want = fps[queries] ^ mask
                spot = np.minimum(np.searchsorted(known, want), len(known) - 1)
                hit = known[spot] == want
                forest.add(order[spot[hit]], queries[hit])
            continue
        todo.append((points[dp <= r], left))
        todo.append((points[dp > r], right))
    return forest.settle()


def linked_pairs(spark: SparkSession, distinct: DataFrame, max_bits: int = MAX_BITS,
                 shard_points: int = SHARD_POINTS) -> DataFrame:
    """Spanning links ``fp, root`` between distinct fingerprints (column ``fp``
    of a landed table); at most one row per fingerprint and shard."""
    n = distinct.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / shard_points)))
    sample = np.zeros(0, dtype=np.uint64)
    if depth:
        # a bounded sample, by a hash of the fingerprint: enough points per node of the tree
        bound = max(SAMPLE_POINTS, 16 * 2**depth)
        part = F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, bound / n))
        sample = np.array([r[0] for r in distinct.where(part).select("fp").collect()], dtype=np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(grow_tree(sample, depth, max_bits))

    def deal(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for lo in range(0, len(fps), 65_536):
                some = fps[lo:lo + 65_536]
                at, shard, home = visits(some.view(np.uint64), tree.value, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(some[at]), pa.array(home)],
                                                 names=["shard", "fp", "home"])

    def linked(pdf):
        import pandas as pd

        pdf = pdf.sort_values("fp", ignore_index=True)  # the forest must not depend on the order of arrival
        fps = np.ascontiguousarray(pdf["fp"].to_numpy())
        label = link(fps.view(np.uint64), pdf["home"].to_numpy(), max_bits)
        child = np.flatnonzero(label != np.arange(len(fps)))
        return pd.DataFrame({"fp": fps[child], "root": fps[label[child]]})

    dealt = map_arrow(distinct.select("fp"), deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(linked, "fp long, root long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``v, p``: every vertex of the links with the label of its component.

    Labels start at the least neighbour.  A round takes the least label among
    the neighbours and then the label of that label; rounds go on until none
    changes.  Each is two joins and one aggregate, landed to cut the lineage.
    """
    # landed before they are turned round: both directions must come from one run of the links
    pairs = landed(spark, links.toDF("a", "b"), "simhash-links")
    edges = landed(spark, pairs.union(pairs.select("b", "a")).distinct(), "simhash-edges")
    label = landed(spark, edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
                   .select("v", F.least("v", "m").alias("p")), "simhash-labels")
    while True:
        seen = edges.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("p").alias("m"))
        hooked = label.join(seen, F.col("v") == F.col("a")).select("v", "p", F.least("p", "m").alias("q"))
        up = label.select(F.col("v").alias("uv"), F.col("p").alias("up"))
        step = landed(spark, hooked.join(up, F.col("q") == F.col("uv")).select(
            "v", F.least("q", "up").alias("p"), F.col("p").alias("was")), "simhash-labels")
        label = step.select("v", "p")
        if step.where("p != was").isEmpty():
            return label


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    shard_points: int = SHARD_POINTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text_hash, fp, component_id`` (smallest id of the group)."""
    with small_batches(spark):
        rows = landed(spark, fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    distinct = landed(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    found = components(spark, linked_pairs(spark, distinct, max_bits, shard_points))
    joined = distinct.join(found, F.col("fp") == F.col("v")).select("fp", "p", "least_id")
    least = joined.groupBy(F.col("p").alias("group_p")).agg(F.min("least_id").alias("component_id"))
    moved = joined.join(least, F.col("p") == F.col("group_p")).select(F.col("fp").alias("moved_fp"), "component_id")
    # landed, so that the join below has a shuffle on either side and AQE can split a hot fingerprint
    by_fp = landed(spark, distinct.join(moved, F.col("fp") == F.col("moved_fp"), "left").select(
        F.col("fp").alias("own_fp"), F.coalesce("component_id", "least_id").alias("component_id")), "simhash-groups")
    return rows.join(by_fp, F.col("fp") == F.col("own_fp")).select(
        "doc_id", "text_hash", "fp", "component_id")


def near_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The input with one document of each group: the one with the smallest id.

    Rows repeated with one id and text are one document: they stay or go
    together.  A group whose ids are all NULL stays.
    """
    found = near_duplicates(spark, docs, id_col=id_col, text_col=text_col, **options)
    gone = landed(spark, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
                  .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(),
                  "simhash-gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    same = (F.xxhash64(text) == F.col("gone_hash")) & F.col("row")[id_col].eqNullSafe(F.col("gone_id"))
    return join_keys(rows, gone, same, "left_anti").select("row.*")
