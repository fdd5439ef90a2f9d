"""Prefix trie of conversations by a splitter skeleton.

A conversation becomes a path: 24 bytes a turn (128-bit digest of role and
text, code points of the text).  Equal paths are added up first, with their
ids in rows of at most ``2^IDS_BITS``.  Splitters are drawn from a bounded
sample of the paths and cut the order of all paths into shards; no conversation
and no copy of it is ever in two shards.  A node whose conversations lie in
several shards is a prefix of a splitter, so the trie of the splitter paths
(the skeleton) is broadcast: a shard reads its sorted paths once, finishes all
other nodes itself and hands out one partial aggregate for each skeleton node
it meets.  These are reduced by node and added up from the leaves of the
skeleton to its root; children that hang off the skeleton then get their
parent's conversation by a broadcast join.

A shard's memory holds one path, and the nodes below one skeleton node that
are not yet told; the ids of equal conversations stream through the digest.
The skeleton has at most ``shards`` splitters, each no longer than needed to
tell it from the sampled path before it, and the sample has at most
``SAMPLE_ROWS`` paths and ``SAMPLE_BYTES`` expected bytes, whatever the input.

Defined results: a NULL role or text is empty; turns without a number come
first and equal numbers stand in order of their digest; rows without a
conversation id belong to no conversation and are passed over; an empty table
gives no rows, not even a root; other columns are passed over.  A very long
text is read once for its digest and never moves; the path of a conversation
is one row (2 GiB hold 80 million turns).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import landed, map_arrow, ship_package, text_or_empty

#: Bytes of a turn in a path.
TURN = 24
IDS_BITS = 12
SHARD_ROWS, SHARD_BYTES, MAX_SHARDS = 200_000, 64_000_000, 4_096
SAMPLE_ROWS, SAMPLE_BYTES = 16 * MAX_SHARDS, 32_000_000
#: Nodes a shard keeps before it tells them.
TOLD_AT_ONCE = 20_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: one binary element a turn, in order."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    element = F.concat(F.unhex(F.md5(content.cast("binary"))), F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 16, "0")))
    return (turns.where(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"),
                                                                            element.alias("element")).alias("t"))
            .groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["element"]).alias("turns")))


def with_shared_heads(spark: SparkSession, turns: DataFrame, group: int = 100, most: int = 6, **columns) -> DataFrame:
    """``conv_id, path``: the first crc32(conv_id) mod ``most`` turns of conversation
    ``conv_id - conv_id % group``, then the own turns after as many."""
    own = landed(spark, paths(turns, **columns), "trie-turns")
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("head_id"),
                                                            F.slice("turns", 1, most - 1).alias("head"))
    n = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("head_id"), "left")
    none = F.array().cast("array<binary>")
    head = F.slice(F.coalesce("head", none), F.lit(1), n)
    whole = F.concat(head, F.slice(F.col("turns"), n + 1, F.size("turns")))
    return joined.select("conv_id", F.unhex(F.array_join(F.transform(whole, lambda x: F.hex(x)), "")).alias("path"))


def common_bytes(a: bytes, b: bytes) -> int:
    """Bytes of the turns that both paths begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n // TURN  # the first lo turns are equal, hi + 1 are not
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid * TURN] == b[:mid * TURN] else (lo, mid - 1)
    return lo * TURN


def splitters(grouped: DataFrame, shards: int, n_rows: int, n_bytes: int) -> list[bytes]:
    """At most ``shards - 1`` cuts of the order of paths, from a bounded sample."""
    share = min(1.0, SAMPLE_ROWS / max(1, n_rows), SAMPLE_BYTES / max(1, n_bytes))
    drawn = F.pmod(F.xxhash64("path", "chunk", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = sorted(r["path"] for r in grouped.where(drawn).select("path").collect())
    found = []
    for k in range(1, shards):
        at = k * len(sample) // shards
        if at and sample[at] != sample[at - 1]:
            cut = bytes(sample[at][:common_bytes(sample[at - 1], sample[at]) + TURN])
            if not found or found[-1] < cut:
                found.append(cut)
    return found


@dataclass
class Skeleton:
    """Trie of the splitter paths.  Node 0 is the root; a node comes after its parent."""

    parent: list[int]
    depth: list[int]
    element: list[bytes]
    child: dict[tuple[int, bytes], int]  # (node, turn) -> node

    @staticmethod
    def of(cuts: list[bytes]) -> Skeleton:
        trie = Skeleton([-1], [0], [b""], {})
        for cut in cuts:
            at = 0
            for k in range(0, len(cut), TURN):
                step = at, cut[k:k + TURN]
                if step not in trie.child:
                    trie.child[step] = len(trie.parent)
                    trie.parent.append(at)
                    trie.depth.append(k // TURN + 1)
                    trie.element.append(step[1])
                at = trie.child[step]
        return trie


def text_length(element: bytes) -> int:
    """Code points of a turn's text; the root has none."""
    return int.from_bytes(element[-8:], "big")


class Shard:
    """Reads sorted paths and tells nodes; skeleton nodes only as partial aggregates."""

    def __init__(self, skeleton: Skeleton):
        self.child, self.path, self.stack = skeleton.child, None, []
        self.told: list[tuple] = []
        self.nodes: list[list] = []  # finished below the skeleton, parents before their children

    def _open(self, path: bytes, depth: int) -> None:
        element, above = path[(depth - 1) * TURN:depth * TURN] if depth else b"", self.stack[-1] if self.stack else None
        number = self.child.get((above["number"], element), -1) if above else 0
        node = {"number": number, "depth": depth, "least": None, "n": 0, "children": 0, "leaves": 0, "saved": 0,
                "length": text_length(element), "ends": None, "parent": above}
        if number < 0:
            self.nodes.append(node)
        self.stack.append(node)

    def _close(self) -> None:
        node = self.stack.pop()
        node["ends"] = node["ends"].hexdigest() if node["ends"] else None
        if node["number"] >= 0:
            self._tell(node, node["number"], None)
            return
        node["leaves"] += node["children"] == 0
        node["saved"] += (node["n"] - 1) * node["length"]
        above = node["parent"]
        above["n"] += node["n"]
        above["children"] += 1
        above["leaves"] += node["leaves"]
        above["saved"] += node["saved"]
        above["least"] = node["least"] if above["least"] is None else min(above["least"], node["least"])
        if above["number"] >= 0:
            for x in self.nodes:
                self._tell(x, x["parent"]["number"], x["parent"]["least"])
            self.nodes = []

    def _tell(self, node: dict, number: int, parent: int | None) -> None:
        own = node["number"] >= 0
        self.told.append((own, number if own or number >= 0 else None, node["least"], node["depth"],
                          None if own or number >= 0 else parent, node["n"], node["children"], node["leaves"], node["saved"],
                          node["ends"]))

    def add(self, path: bytes, ids: list[int]) -> None:
        """Conversations (ids ascending) that are this path."""
        if path != self.path:
            keep = common_bytes(self.path, path) // TURN + 1 if self.path is not None else 0
            while len(self.stack) > keep:
                self._close()
            for depth in range(len(self.stack), len(path) // TURN + 1):
                self._open(path, depth)
            self.path = path
        node = self.stack[-1]
        node["least"] = ids[0] if node["least"] is None else min(node["least"], ids[0])
        node["n"] += len(ids)
        text = ",".join(map(str, ids))
        if node["ends"] is None:
            node["ends"] = hashlib.sha256(text.encode())
        else:
            node["ends"].update(b"," + text.encode())

    def end(self) -> None:
        while self.stack:
            self._close()
        self.path = None


TOLD = ("partial boolean, number int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
NOTHING = hashlib.sha256(b"").hexdigest()


def shard_nodes(spark: SparkSession, grouped: DataFrame, cuts: list[bytes], skeleton: Skeleton, tasks: int) -> DataFrame:
    """Landed rows of all shards: finished nodes (with the number of their parent if
    that is a skeleton node) and partial aggregates of skeleton nodes."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast((cuts, skeleton))

    @F.pandas_udf("int")
    def shard_of(path: pd.Series) -> pd.Series:
        cuts = shared.value[0]
        return pd.Series([bisect_right(cuts, p) for p in path], dtype="int32")

    def read(batches):
        shard, at = Shard(shared.value[1]), None

        def out():
            rows, shard.told = shard.told, []
            names = [c.split()[0] for c in TOLD.split(", ")]
            kinds = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(x), kinds[c.split()[1]])
                                               for x, c in zip(columns, TOLD.split(", "), strict=True)], names=names)

        for batch in batches:
            for own, path, ids in zip(*(batch.column(c) for c in ("shard", "path", "ids")), strict=True):
                if own.as_py() != at:
                    shard.end()
                    at = own.as_py()
                shard.add(path.as_py(), ids.as_py())
                if len(shard.told) >= TOLD_AT_ONCE:
                    yield out()
        shard.end()
        yield out()

    dealt = grouped.select(shard_of("path").alias("shard"), "path", "chunk", "ids").repartition(tasks, "shard") \
        .sortWithinPartitions("shard", "path", "chunk").select("shard", "path", "ids")
    return landed(spark, map_arrow(dealt, read, TOLD), "trie-nodes")


def finished_skeleton(told: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """Rows of the skeleton nodes: partial aggregates reduced by node, then added up
    from the last node to the root."""
    reduced = told.where("partial").groupBy("number").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("ends_sha256"))
    sums = {r[0]: list(r)[1:] for r in reduced.collect()}  # one for each node of the skeleton
    for number in range(len(skeleton.parent) - 1, -1, -1):
        own, up = sums[number], sums.get(skeleton.parent[number])
        own[3] += own[2] == 0
        own[4] += (own[1] - 1) * text_length(skeleton.element[number])
        if up:
            up[0] = own[0] if up[0] is None else min(up[0], own[0])
            for k, x in ((1, own[1]), (2, 1), (3, own[3]), (4, own[4])):
                up[k] += x
    return [(number, own[0], skeleton.depth[number], sums[skeleton.parent[number]][0] if number else None, *own[1:5],
             own[5] or NOTHING) for number, own in sorted(sums.items())]


def prefix_trie(spark: SparkSession, conversations: DataFrame, shard_rows: int = SHARD_ROWS,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per node of the trie of ``conv_id, path`` rows (see ``NODE``)."""
    grouped = landed(spark, conversations.groupBy("path", F.shiftright("conv_id", IDS_BITS).alias("chunk"))
                     .agg(F.sort_array(F.collect_list("conv_id")).alias("ids")), "trie-paths")
    n_rows, n_bytes = grouped.agg(F.count("*"), F.sum(F.length("path"))).first()
    if not n_rows:
        return spark.createDataFrame([], NODE)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // shard_rows), -(-n_bytes // shard_bytes))
    cuts = splitters(grouped, min(MAX_SHARDS, 4 * tasks), n_rows, n_bytes)
    skeleton = Skeleton.of(cuts)
    told = shard_nodes(spark, grouped, cuts, skeleton, min(tasks, len(cuts) + 1))
    top = spark.createDataFrame(finished_skeleton(told, skeleton), f"number int, {NODE}")
    below = told.where("NOT partial").drop("partial").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    above = F.broadcast(top.select(F.col("number").alias("above"), F.col("conv_id").alias("above_id")))
    hung = below.join(above, F.col("number") == F.col("above"), "left") \
        .withColumn("parent_conv_id", F.coalesce("above_id", "parent_conv_id"))
    names = [c.split()[0] for c in NODE.split(", ")]
    return top.select(*names).unionByName(hung.select(*names))
