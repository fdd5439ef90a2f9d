"""Packing documents into windows of a fixed number of tokens.

Best-fit decreasing: overlong documents are first cut into full windows; the
pieces, longest first, go to the open window with the least room that still
fits, which a segment tree over the remaining capacities finds.

The tokenizer runs where the rows are read and the pieces are landed, so no
text or id is shuffled and a lost executor repeats no tokenizing.  Packing then
runs on shards of a bounded number of pieces.  Shards are dealt by row number,
not by key, so copies of one document or NULL ids never meet in one task; each
shard leaves at most a few partly filled windows.

Defined results: a NULL text is empty and gives one piece that holds the end
id; repeated rows and NULL ids are packed like any other row; an empty table
gives no rows; other columns of the input are passed over.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.bpe import encoder
from tidepool.llm.common import landed, map_arrow, release_memory, ship_package, small_batches, text_or_empty

WINDOW = 2048
PIECES_PER_SHARD = 50_000
#: Characters whose ids are made at once.
CHARS_AT_ONCE = 2_000_000


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut each document's ids into full windows and a rest.

    ``tokenizer`` is the path of the vocabulary file on every executor.
    Rows: ``doc_id, start, length, doc_tokens, ids`` (little-endian unsigned
    32-bit binary).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        import numpy as np

        for batch in batches:
            sizes, lo = pc.utf8_length(batch.column("text")).to_pylist(), 0
            while lo < len(sizes):  # ids of a bounded number of characters at once
                hi, chars = lo, 0
                while hi < len(sizes) and (hi == lo or chars + sizes[hi] <= CHARS_AT_ONCE):
                    chars += sizes[hi]
                    hi += 1
                ids, n = encoder(tokenizer).encode(batch.column("text").slice(lo, hi - lo).to_pylist(), end_id)
                pieces = -(-n // window)
                doc = np.repeat(np.arange(len(n)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, n[doc] - start)
                ends = np.concatenate([[0], np.cumsum(length)]) * 4
                blob = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), pa.array(start),
                     pa.array(length), pa.array(n[doc]), blob.cast(pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"])
                del ids, ends, blob
                lo = hi
            del batch
            release_memory()

    return map_arrow(rows, cut, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


class OpenWindows:
    """Open windows by remaining capacity under a segment tree of counts."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.base)
        self.windows: list[list[int]] = [[] for _ in range(self.base)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.base + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``."""
        node, count = self.base + need, self.count
        if not count[node]:
            # up to the first right-hand sibling that holds a window, then down its left side
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node + (not count[2 * node])
        room = node - self.base
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.windows[room].pop()


def best_fit(lengths, capacity: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window and offset of each length; the lengths come longest first."""
    tree, used, windows, offsets = OpenWindows(capacity), 0, [], []
    for n in lengths:
        found = tree.take(n)
        if found is None:
            room, window = capacity, used
            used += 1
        else:
            room, window = found
        windows.append(window)
        offsets.append(capacity - room)
        if room > n:
            tree.put(room - n, window)
    return windows, offsets


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = WINDOW,
         pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length`` of
    1 to ``capacity``; all other columns stay."""
    with small_batches(spark):
        pieces = landed(spark, pieces, "pieces")
    shards = max(1, -(-pieces.count() // pieces_per_shard))
    dealt = pieces.withColumn("piece_row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("piece_row"), F.lit(shards)))

    def fill(pdf):
        pdf = pdf.sort_values(["length", "piece_row"], ascending=[False, True], ignore_index=True)
        windows, offsets = best_fit(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = [(int(pdf["shard"].iat[0]) << 32) + w for w in windows]
        pdf["offset"] = offsets
        return pdf.drop(columns=["shard", "piece_row"])

    ship_package(spark)
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(fill, schema)


def sequences(packed: DataFrame, capacity: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The windows themselves: ``sequence_id, n_tokens, ids`` with ``ids``
    padded to ``capacity``, unless the tokens end at a power of two.

    ``packed`` carries the ``ids`` of its pieces.  A group is one window, so at
    most ``capacity`` tokens meet in it.
    """
    whole = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
        F.sum("length").cast("long").alias("n_tokens"))
    pad = F.unhex(F.lit(pad_id.to_bytes(4, "little").hex()))
    # binary columns have no repeat: the padding is cut from one literal window
    blank = F.unhex(F.lit(pad_id.to_bytes(4, "little").hex() * capacity))
    power = F.bit_count("n_tokens") == 1
    joined = F.aggregate("parts", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"]))
    missing = F.when(power, F.lit(0)).otherwise(F.lit(capacity) - F.col("n_tokens")).cast("int")
    return whole.select("sequence_id", "n_tokens",
                        F.concat(joined, F.substring(blank, F.lit(1), missing * F.octet_length(pad))).alias("ids"))
