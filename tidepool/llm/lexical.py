"""Ranked lexical search for many stated queries at once, with shared work.

Every item of a query table is a bag of terms.  Sets of terms that several
items share are mined first: terms held by exactly the same items form one
leaf, and neighbouring nodes that stand side by side in two or more items (in
order of how many items hold them) are joined, round by round, into inner
nodes.  The result is a query-sharing DAG.  For a block of documents each
node's partial score is materialised once, from leaves to inner nodes, and an
item's score is the sum of the few nodes that are left of it.

Texts are read once per block of items: a task counts all terms of a whole
text and keeps those the items ask for.  Number of documents, length of the
corpus and document frequencies are Spark aggregates over all documents.  Each
task holds back documents that cannot be among its best ``k`` of an item; the
rest meet in a window that Spark limits to ``k`` rows before its shuffle too.

Items are taken in blocks of about ``block_bytes`` of text, so what is
broadcast (terms and DAG of one block) is bounded whatever the query table.

Defined results: a NULL or empty text, or one without terms, has no terms; as
a document it counts neither in N nor in L, as an item it finds nothing.
Repeated items are answered each, repeated documents are found each; a NULL
``doc_id`` comes after all others in ties; an empty table gives no rows; other
columns are passed over.  A very long text is one row, at most Spark's 2 GiB.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import landed, map_arrow, text_or_empty

TOP = 10
#: Bytes of item texts per block; numbers held at once for the nodes of a block of documents.
BLOCK_BYTES = 4_000_000
CELLS = 2_000_000
#: Fixed values of the ranking: 1000 times the share of length, and of saturation, as whole numbers.
#: A term is a run of ASCII letters and digits and of all other characters beyond ASCII.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a UTF-8 text, in order; only A-Z are lower-cased."""
    return text.translate(FOLD).split()


@dataclass
class QueryDag:
    """Nodes are numbered leaves first, then inner nodes round by round."""

    n_nodes: int
    leaf_terms: np.ndarray  # parallel: term, the leaf it adds to, how many times
    leaf_nodes: np.ndarray
    leaf_times: np.ndarray
    rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # node, its two parts
    items: np.ndarray  # items with terms
    parts: np.ndarray  # nodes that add up to each of these items
    starts: np.ndarray


def mine(items: list[Counter]) -> QueryDag:
    """The sharing DAG of items given as counts of term numbers."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for k, counts in enumerate(items):
        for term, times in counts.items():
            holders[term, times].append(k)
    leaves: dict[tuple[int, ...], int] = {}
    leaf = {atom: leaves.setdefault(tuple(own), len(leaves)) for atom, own in holders.items()}
    wide = sorted(leaves.items(), key=lambda x: (-len(x[0]), x[1]))
    left: list[list[int]] = [[] for _ in items]
    for own, node in wide:
        for k in own:
            left[k].append(node)
    n_nodes, rounds = len(leaves), []
    while True:
        side = Counter(p for nodes in left for p in pairwise(nodes))
        made: dict[tuple[int, int], int] = {}
        for k, nodes in enumerate(left):
            out, i = [], 0
            while i < len(nodes):
                pair = (nodes[i], nodes[i + 1]) if i + 1 < len(nodes) else None
                after = side[nodes[i + 1], nodes[i + 2]] if i + 2 < len(nodes) else 0
                if pair and side[pair] >= 2 and side[pair] >= after:
                    out.append(made.setdefault(pair, n_nodes + len(made)))
                    i += 2
                else:
                    out.append(nodes[i])
                    i += 1
            left[k] = out
        if not made:
            break
        n_nodes += len(made)
        rounds.append((np.array(list(made.values())), *np.array(list(made)).T))
    filled = [k for k, nodes in enumerate(left) if nodes]
    sizes = np.array([len(left[k]) for k in filled], dtype=np.int64)
    atoms = np.array([(t, n, times) for (t, times), n in leaf.items()], dtype=np.int64).reshape(-1, 3)
    atoms = atoms[np.argsort(atoms[:, 0], kind="stable")]
    return QueryDag(n_nodes, atoms[:, 0], atoms[:, 1], atoms[:, 2], rounds, np.array(filled, dtype=np.int64),
                    np.fromiter(chain.from_iterable(left[k] for k in filled), dtype=np.int64), np.cumsum(sizes) - sizes)


def item_scores(dag: QueryDag, docs: np.ndarray, terms: np.ndarray, gains: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of every item (with terms) for ``n_docs`` documents; ``gains`` are
    the weighted, saturated counts of ``terms`` in ``docs``."""
    lo, hi = (np.searchsorted(dag.leaf_terms, terms, side) for side in ("left", "right"))
    n = hi - lo
    atom = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
    partial = np.zeros((dag.n_nodes, n_docs), dtype=np.int64)
    np.add.at(partial, (dag.leaf_nodes[atom], np.repeat(docs, n)), np.repeat(gains, n) * dag.leaf_times[atom])
    for node, a, b in dag.rounds:
        partial[node] = partial[a] + partial[b]
    return np.add.reduceat(partial[dag.parts], dag.starts, axis=0)


def asked_counts(docs: DataFrame, known: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: length of each whole text and its counts of the known terms."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        asked = shared.value
        for batch in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                own = Counter(filter(asked.__contains__, words))
                n.append(len(words))
                terms += [asked[t] for t in own]
                tfs += own.values()
                ends.append(len(terms))
            at = np.array(ends, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return map_arrow(rows, count, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def best_of_tasks(spark: SparkSession, counted: DataFrame, dag: QueryDag, weights: np.ndarray, top: int) -> DataFrame:
    """``item, doc_id, score`` of all documents that may be among the best of an item.

    ``counted`` has ``doc_id, m, terms, tfs``."""
    shared, per_block = spark.sparkContext.broadcast((dag, weights)), max(1, CELLS // max(1, dag.n_nodes))
    kind = counted.schema["doc_id"].dataType.simpleString()

    def search(batches):
        dag, weights = shared.value
        best = np.zeros((len(dag.items), top), dtype=np.int64)  # the task's highest scores so far
        for batch in batches:
            # in order of doc_id, so that of equal scores the first ones stay
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            for lo in range(0, batch.num_rows, per_block):
                part = batch.slice(lo, per_block)
                held = np.diff(part.column("terms").offsets.to_numpy())
                terms, tfs = (part.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
                gains = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(part.column("m").to_numpy(), held)))
                found = item_scores(dag, np.repeat(np.arange(part.num_rows), held), terms, gains, part.num_rows)
                if part.num_rows > top:
                    first = np.argsort(-found, axis=1, kind="stable")[:, :top]
                else:
                    first = np.broadcast_to(np.arange(part.num_rows), found.shape)
                score = np.take_along_axis(found, first, axis=1)
                best = -np.sort(-np.hstack([best, score]), axis=1)[:, :top]
                item, place = np.nonzero((score > 0) & (score >= best[:, -1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dag.items[item].astype(np.int32)), part.column("doc_id").take(pa.array(first[item, place])),
                     pa.array(score[item, place])], names=["item", "doc_id", "score"])

    return map_arrow(counted, search, f"item int, doc_id {kind}, score long")


def ranked_search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents with a score above 0."""
    asked = items.select(F.col(item_col).alias("item_id"), text_or_empty(item_text_col).cast("binary").alias("text"))
    item_kind, doc_kind = asked.schema["item_id"].dataType, docs.schema[id_col].dataType
    n_blocks = -(-(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // block_bytes)
    block = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(max(1, n_blocks)))
    found, totals = [], None
    for b in range(n_blocks):
        own = asked.where(block == b).collect()  # about block_bytes
        known: dict[bytes, int] = {}
        dag = mine([Counter(known.setdefault(t, len(known)) for t in terms_of(r["text"])) for r in own])
        if not known:
            continue
        counted = landed(spark, asked_counts(docs, known, id_col, text_col), "lexical-counts")
        if totals is None:
            totals = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        n_docs, length = totals
        if not length:
            break
        weights = np.zeros(len(known), dtype=np.int64)
        for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        m = F.expr(f"25 + CAST(n AS DECIMAL(20,0)) * CAST({75 * n_docs} AS DECIMAL(18,0)) div CAST({length} AS DECIMAL(18,0))")
        best = best_of_tasks(spark, counted.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs"),
                             dag, weights, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(own)], f"item int, item_id {item_kind.simpleString()}")
        found.append(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {item_kind.simpleString()}, rank int, doc_id {doc_kind.simpleString()}, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
