"""Token ids in flat binary files.

Format of one part: ``<name>.ids`` holds the ids of its documents one after
the other as little-endian unsigned integers (16 bits if the vocabulary has at
most 65,536 ids, else 32); ``<name>.off`` holds the 64-bit offset of each
document from the start of the part, and one more for its end;
``<name>.doc`` holds the 64-bit document ids and ``<name>.nil`` a byte per
document that is 1 where the id is NULL.  Documents lie in ascending id order
within and across the parts, NULL first.  The table ``parts`` has a row per part with its base: the number of ids
in all parts before it, a prefix sum over the parts.

A task writes under a name of its own attempt and only the names of attempts
that succeeded reach the table, so a lost executor or a second attempt leaves
no half part behind.  The folder must be one that all executors share.

Parts are ranges of the id, then of the text's beginning and hash, so that rows
without an id, or of one id, spread over parts like all others.

Defined results: a NULL text is empty and holds the end id only; repeated rows
and ties of the id are ordered by the text's first characters, then by its
hash; an empty table has no part; other columns of the input are passed over.
A very long text is encoded whole (one row, at most Spark's 2 GiB).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.bpe import encoder
from tidepool.llm.common import landed, map_arrow, text_or_empty
from tidepool.session import scratch_path

#: Characters of a text that order rows of one id.
FIRST_CHARS = 64
#: Ids handed on in one Arrow batch when files are read.
IDS_PER_BATCH = 4_000_000


def shared_fs(folder: str):
    """Arrow file system and path of a folder given by URI or plain path."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def write_token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; the table of parts: ``part, name, n_docs, n_ids, base,
    width, folder``."""
    folder = folder or scratch_path(spark, "llm-token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    # equal rows differ by a salt only, which parts them without a meaning for their order
    order = [F.asc_nulls_first("doc_id"), F.substring("text", 1, FIRST_CHARS), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order, F.pmod(F.monotonically_increasing_id(), F.lit(1024))).sortWithinPartitions(*order, "text")

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = shared_fs(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        tok = encoder(tokenizer)
        kind = np.dtype("<u2" if tok.size <= 1 << 16 and end_id < 1 << 16 else "<u4")
        out, ids_seen, offsets, doc_ids, nils = None, 0, [np.zeros(1, dtype="<u8")], [], []
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}.ids")
                ids, n = tok.encode(batch.column("text").to_pylist(), end_id)
                out.write(ids.astype(kind).tobytes())
                offsets.append((ids_seen + np.cumsum(n)).astype("<u8"))
                doc_ids.append(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nils.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype("u1"))
                ids_seen += len(ids)
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        for end, arrays in (("off", offsets), ("doc", doc_ids), ("nil", nils)):
            with store.open_output_stream(f"{root}/{name}.{end}") as f:
                f.write(np.concatenate(arrays).tobytes())
        yield pa.RecordBatch.from_pylist([{
            "part": task.partitionId(), "name": name, "n_docs": sum(map(len, doc_ids)), "n_ids": ids_seen,
            "width": kind.itemsize}])

    kinds = "part long, name string, n_docs long, n_ids long, width long"
    # one short row per part: the number of tasks bounds it, not the data
    parts = sorted(landed(spark, map_arrow(rows, write, kinds), "token-parts").collect())
    bases = np.cumsum([0, *[p["n_ids"] for p in parts]])
    table = [(p["part"], p["name"], p["n_docs"], p["n_ids"], int(b), p["width"], folder)
             for p, b in zip(parts, bases, strict=False)]
    return spark.createDataFrame(
        table, "part long, name string, n_docs long, n_ids long, base long, width long, folder string")


def _map(store, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it lies in a file system, else read."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if store.get_file_info(path).size else np.zeros(0, dtype=kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=kind)


def read_token_files(parts: DataFrame) -> DataFrame:
    """Documents of the files: ``doc_id, start, n_tokens, ids`` where ``start``
    counts the ids of all documents before and ``ids`` is little-endian
    unsigned 32-bit binary.  One task per part."""
    n = max(1, parts.count())

    def read(batches):
        for batch in batches:
            for p in batch.to_pylist():
                store, root = shared_fs(p["folder"])
                ids = _map(store, f"{root}/{p['name']}.ids", "<u2" if p["width"] == 2 else "<u4")
                off = _map(store, f"{root}/{p['name']}.off", "<u8").astype(np.int64)
                doc, nil = _map(store, f"{root}/{p['name']}.doc", "<i8"), _map(store, f"{root}/{p['name']}.nil", "u1")
                lo = 0
                while lo < len(doc):
                    hi = max(lo + 1, int(np.searchsorted(off, off[lo] + IDS_PER_BATCH, "right")) - 1)
                    hi = min(hi, len(doc))
                    block = np.ascontiguousarray(ids[off[lo]:off[hi]], dtype="<u4")
                    ends = (off[lo:hi + 1] - off[lo]) * 4
                    blob = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(block)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(doc[lo:hi]), mask=np.array(nil[lo:hi]) > 0), pa.array(p["base"] + off[lo:hi]),
                         pa.array(off[lo + 1:hi + 1] - off[lo:hi]), blob.cast(pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    lo = hi

    spread = parts.repartition(n)
    return map_arrow(spread, read, "doc_id long, start long, n_tokens long, ids binary")
