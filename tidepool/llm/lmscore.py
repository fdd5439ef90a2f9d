"""Cross-entropy difference between two n-gram language models.

A target model is counted over the documents of a target domain and a
background model over all documents.  Both share one vocabulary, that of a
public byte-level tokenizer, so no text has an unknown token, and are smoothed
alike (Witten-Bell, pairs of ids down to single ids).  A document scores the
mean over its tokens of target loss minus background loss; lower is closer to
the target.  Target documents are scored by the model they were counted in, as
part of the domain they define.

Texts are landed as blocks of ids.  A block sends the pairs it holds, each
once, in one packed row per bucket of pairs.  The pairs' counts are a landed
table that grows with the corpus and is never broadcast or collected (what has
one row per id of the vocabulary is).  Bucket by bucket the losses of the
model meet the blocks' packed pairs and go back as packed losses, which a block
adds up per document.  A frequent pair meets in one place per block, not per
document, and a bucket holds at most vocabulary^2 / ``BUCKETS`` pairs.

Defined results: a NULL or empty text has no token and NULL losses; without
target documents the target model is uniform; a NULL id is never a target;
repeated rows are counted and scored each; an empty table gives no rows; other
columns of the input are passed over.  A very long text is a block of its own
(one row, at most Spark's 2 GiB).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.bpe import ChunkEncoder, encoder
from tidepool.llm.common import join_keys, landed, map_arrow, text_or_empty

#: Chunks a task remembers for the time it cuts texts into ids, and characters it cuts at once.
MAX_CHUNKS = 150_000
CHARS_PER_STEP = 600_000
#: Characters of a block of texts; stands before the first id of a text.
CHARS_PER_BLOCK = 2_500_000
FRONT = (1 << 16) - 1
#: Buckets of pairs; pairs that a task adds up before it tells their counts.
BUCKETS = 256
PAIRS_AT_ONCE = 1_000_000


def marked_rows(spark: SparkSession, docs: DataFrame, targets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, chosen``; ``targets`` has the column ``target_id``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keys = landed(spark, targets.select("target_id").where("target_id is not null").distinct(), "lm-targets") \
        .withColumn("chosen", F.lit(True))
    return join_keys(rows, keys, F.col("doc_id") == F.col("target_id"), "left") \
        .select("doc_id", "text", F.coalesce("chosen", F.lit(False)).alias("chosen"))


def token_blocks(spark: SparkSession, docs: DataFrame, targets: DataFrame, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Landed ``block, doc_ids, chosen, sizes, ids``: each row holds the ids of some
    documents one after the other as unsigned 16-bit binary.  The task's memory of
    chunks goes with the task, as the stages after it need none."""
    rows = marked_rows(spark, docs, targets, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def write(batches):
        from pyspark import TaskContext

        tok, block = ChunkEncoder(tokenizer, MAX_CHUNKS, CHARS_PER_STEP), TaskContext.get().partitionId() << 32
        if tok.size > FRONT:
            raise ValueError(f"more than {FRONT} ids")
        for batch in batches:
            size, lo = pc.utf8_length(batch.column("text")).to_numpy(), 0
            while lo < len(size):
                # as many texts as a block has room for, one at least
                hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:]), CHARS_PER_BLOCK, side="right")))
                ids, sizes = tok.encode(batch.column("text").slice(lo, hi - lo).to_pylist())
                whole = np.array([0, hi - lo], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.ListArray.from_arrays(whole, batch.column("doc_id").slice(lo, hi - lo)),
                     pa.ListArray.from_arrays(whole, batch.column("chosen").slice(lo, hi - lo)),
                     pa.ListArray.from_arrays(whole, pa.array(sizes.astype(np.int64))),
                     pa.array([ids.astype("<u2").tobytes()], pa.binary())],
                    names=["block", "doc_ids", "chosen", "sizes", "ids"])
                block, lo = block + 1, hi

    kinds = f"block long, doc_ids array<{kind}>, chosen array<boolean>, sizes array<long>, ids binary"
    return landed(spark, map_arrow(rows, write, kinds), "lm-blocks")


def pairs(ids: bytes, sizes: np.ndarray) -> np.ndarray:
    """Numbers of the pairs that end at each id of a block; ``FRONT`` comes before each text."""
    ids = np.frombuffer(ids, dtype="<u2").astype(np.int64)
    before = np.concatenate([np.full(min(1, len(ids)), FRONT), ids[:-1]])
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = FRONT
    return before << 16 | ids


def bucket_of(grams: np.ndarray) -> np.ndarray:
    """Bucket of each pair, as ``bucket_of_column``."""
    return ((grams >> 16) * 40503 + (grams & FRONT) * 9973) % BUCKETS


def bucket_of_column(gram: Column) -> Column:
    return (F.shiftright(gram, 16) * 40503 + gram.bitwiseAND(FRONT) * 9973) % BUCKETS


def bucketed(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs by bucket and number, the end of each bucket, and the place of every pair given."""
    every, number = np.unique(grams, return_inverse=True)
    bucket = bucket_of(every)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(every), dtype=np.int64)
    place[order] = np.arange(len(every))
    return every[order], np.cumsum(np.bincount(bucket, minlength=BUCKETS)), place[number]


def block_pairs(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """Landed ``block, bucket, grams, target, background``: each block's distinct pairs
    (64-bit) and their counts (32-bit), packed in one row per bucket."""

    def count(batches):
        for batch in batches:
            for block, chosen, sizes, ids in zip(*(batch.column(c) for c in ("block", "chosen", "sizes", "ids")), strict=True):
                sizes = sizes.values.to_numpy()
                grams = pairs(ids.as_py(), sizes)
                every, ends, place = bucketed(grams)
                background = np.bincount(place, minlength=len(every)).astype("<i4")
                own = np.repeat(chosen.values.to_numpy(zero_copy_only=False), sizes)
                target = np.bincount(place[own], minlength=len(every)).astype("<i4")
                bounds = list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
                packed = [pa.array([x[lo:hi].tobytes() for lo, hi in bounds], pa.binary()) for x in (every.astype("<i8"), target, background)]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * BUCKETS, pa.int64()), pa.array(np.arange(BUCKETS, dtype=np.int32)),
                                                  *packed], names=["block", "bucket", "grams", "target", "background"])

    counted = map_arrow(blocks.select("block", "chosen", "sizes", "ids"), count,
                        "block long, bucket int, grams binary, target binary, background binary")
    return landed(spark, counted, "lm-block-pairs")


def pair_counts(spark: SparkSession, held: DataFrame) -> DataFrame:
    """Landed ``gram, target, background`` over all blocks."""

    def add_up(batches):
        parts, n = [], 0

        def told():
            grams, target, background = (np.concatenate(x) for x in zip(*parts, strict=True))
            every, number = np.unique(grams, return_inverse=True)
            sums = [np.zeros(len(every), dtype=np.int64) for _ in range(2)]
            for total, x in zip(sums, (target, background), strict=True):
                np.add.at(total, number, x)
            return pa.RecordBatch.from_arrays([pa.array(every), *map(pa.array, sums)], names=["gram", "target", "background"])

        for batch in batches:
            for grams, *counts in zip(*(batch.column(c).to_pylist() for c in ("grams", "target", "background")), strict=True):
                parts.append([np.frombuffer(grams, dtype="<i8"), *(np.frombuffer(c, dtype="<i4") for c in counts)])
                n += len(parts[-1][0])
                if n >= PAIRS_AT_ONCE:
                    yield told()
                    parts, n = [], 0
        if parts:
            yield told()

    added = map_arrow(held.select("grams", "target", "background"), add_up, "gram long, target long, background long")
    return landed(spark, added.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background")), "lm-pairs")


def pair_losses(spark: SparkSession, counts: DataFrame, n_ids: int) -> DataFrame:
    """``gram, target_loss, background_loss`` of landed counts, Witten-Bell smoothed."""
    context, last = F.shiftright("gram", 16).alias("context"), F.col("gram").bitwiseAND(FRONT).alias("last")
    sums = [F.sum("target").alias("t_last"), F.sum("background").alias("b_last")]
    # one row per id of the vocabulary at most: these may be broadcast
    lasts = landed(spark, counts.groupBy(last).agg(*sums), "lm-ids")
    contexts = landed(spark, counts.groupBy(context).agg(
        F.sum("target").alias("t_sum"), F.count_if(F.col("target") > 0).alias("t_kinds"),
        F.sum("background").alias("b_sum"), F.count("*").alias("b_kinds")), "lm-contexts")
    totals = lasts.agg(F.sum("t_last"), F.sum("b_last")).first()
    rows = counts.select("*", context, last).join(F.broadcast(contexts), "context").join(F.broadcast(lasts), "last")

    def loss(count, m, total):
        one = (F.col(f"{m}_last") + 1.0) / ((total or 0) + n_ids)
        seen = F.col(f"{m}_sum") + F.col(f"{m}_kinds")
        return -F.log(F.when(seen > 0, (F.col(count) + F.col(f"{m}_kinds") * one) / seen).otherwise(one))

    return rows.select("gram", loss("target", "t", totals[0]).alias("target_loss"),
                       loss("background", "b", totals[1]).alias("background_loss"))


def subword_difference(spark: SparkSession, docs: DataFrame, targets: DataFrame, tokenizer: str,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, target_loss, background_loss, score``."""
    blocks = token_blocks(spark, docs, targets, tokenizer, id_col, text_col)
    held = block_pairs(spark, blocks)
    losses = pair_losses(spark, pair_counts(spark, held), encoder(tokenizer).size)
    # in each bucket the model's pairs come first, in order, and then the blocks' packed pairs
    model = losses.withColumn("bucket", bucket_of_column(F.col("gram")).cast("int"))
    met = model.unionByName(held.select("bucket", "block", "grams"), allowMissingColumns=True) \
        .repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first(), "gram") \
        .select("bucket", "block", "gram", "target_loss", "background_loss", "grams")

    def look_up(batches):
        at, parts, table = None, [], None
        for batch in batches:
            bucket, known = batch.column("bucket").to_numpy(), batch.column("block").is_null().to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero((np.diff(bucket) != 0) | (np.diff(known) != 0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if bucket[lo] != at:
                    at, parts, table = bucket[lo], [], None
                if known[lo]:
                    parts.append([part.column(c).to_numpy() for c in ("gram", "target_loss", "background_loss")])
                    continue
                if table is None:
                    table, parts = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else None, []
                found = []
                for grams in part.column("grams").to_pylist():
                    place = np.searchsorted(table[0], np.frombuffer(grams, dtype="<i8")) if grams else np.zeros(0, dtype=np.int64)
                    found.append([table[m][place].tobytes() for m in (1, 2)] if grams else [b"", b""])
                yield pa.RecordBatch.from_arrays([part.column("block"), part.column("bucket"), *(pa.array(list(x), pa.binary())
                                                                                                for x in zip(*found, strict=True))],
                                                 names=["block", "bucket", "target_loss", "background_loss"])

    packed = map_arrow(met, look_up, "block long, bucket int, target_loss binary, background_loss binary")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # the packed losses of a block come first, in order of the bucket, and then its texts
    # (empty arrays, as Spark's Arrow writer takes time with the square of the rows where lists are NULL)
    none = [F.array().cast(blocks.schema[c].dataType).alias(c) for c in ("doc_ids", "sizes")]
    rows = packed.select("*", *none).unionByName(blocks.select("block", "doc_ids", "sizes", "ids"), allowMissingColumns=True) \
        .repartition("block").sortWithinPartitions("block", F.col("bucket").asc_nulls_last())

    def score(batches):
        known = []
        for batch in batches:
            ended = batch.column("bucket").is_null().to_numpy(zero_copy_only=False)
            for k in range(batch.num_rows):
                if not ended[k]:
                    known.append([np.frombuffer(batch.column(c)[k].as_py(), dtype="<f8") for c in ("target_loss", "background_loss")])
                    continue
                loss, known = [np.concatenate(x) for x in zip(*known, strict=True)], []
                sizes = batch.column("sizes")[k].values.to_numpy()
                place = bucketed(pairs(batch.column("ids")[k].as_py(), sizes))[2]
                empty, starts = sizes == 0, np.cumsum(sizes) - sizes
                mean = np.zeros((2, len(sizes)))
                if len(place):
                    for m in (0, 1):
                        mean[m, ~empty] = np.add.reduceat(loss[m][place], starts[~empty]) / sizes[~empty]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, pa.array(sizes), pa.array(mean[0], mask=empty),
                     pa.array(mean[1], mask=empty), pa.array(mean[0] - mean[1], mask=empty)],
                    names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return map_arrow(rows, score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double")
