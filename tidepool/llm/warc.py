"""Web archives with a merged capture index.

``write_archives`` writes one gzipped WARC file per task, a record per page.
Of pages with equal payloads of at least ``least_bytes`` the one with the
smallest id is a full response, the others are revisit records that refer to
it; shorter payloads are always full.  Each file comes with its capture run:
index entries sorted by URL key, timestamp and id.

``merge_runs`` joins the runs into one globally ordered index.  Spark deals
the entries to ranges of (URL key, timestamp, id), so a URL with many captures
is cut by time; in each range a loser tree merges the slices of the runs.
``read_archives`` reads records back at the offsets the index names.

A task writes under a name of its own attempt, and only names of attempts that
succeeded reach the runs.  The folder must be one all executors share.

Defined results: a NULL payload is empty; a NULL or malformed URL has the
empty key; a NULL id is smaller than none, so it becomes a response only if
all ids of its payload are NULL; rows repeated with the smallest id are all
responses; an empty table gives no file and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import join_keys, landed, map_arrow
from tidepool.llm.token_files import shared_fs
from tidepool.session import scratch_path

LEAST_BYTES = 100
#: Fixed value of the format: a revisit of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = ("url_key string, captured string, page_id long, record_type string, run string, place long, "
         "offset long, length long")


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels from the right, then path and query."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host = parts.hostname or ""
    except ValueError:
        return ""
    if not host:
        return ""
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def _record(row: dict) -> bytes:
    """One WARC/1.1 record, ended by two empty lines."""
    payload = row["payload"]
    digest = hashlib.sha256(payload).hexdigest()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http + (b"" if row["record_type"] == "revisit" else payload)
    day = row["captured"]
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:page:{row['page_id']}>",
        f"WARC-Date: {day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=SAFE_URL)}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{row['refers_to']}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


SAFE_URL = "%/:?#[]@!$&'()*+,;=~"


def _parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda name: (lambda m: int(m[1]) if m else None)(re.search(r"<urn:page:(-?\d+)>", fields.get(name, "")))
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"],
            "refers_to": number("WARC-Refers-To"), "url": fields.get("WARC-Target-URI", ""),
            "payload": None if revisit else payload, "payload_bytes": size if revisit else len(payload),
            "stated_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:")}


def write_archives(spark: SparkSession, pages: DataFrame, captured: Column, folder: str | None = None,
                   least_bytes: int = LEAST_BYTES, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> tuple[DataFrame, str]:
    """Write the files; the landed runs (one per file) and the folder.

    ``captured`` is a timestamp column.  Payloads are not shuffled unless the
    table of repeated payloads is too long to broadcast.
    """
    folder = folder or scratch_path(spark, "llm-warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.unhex(F.lit(""))).alias("payload"),
                        F.date_format(captured, "yyyyMMddHHmmss").alias("captured"))
    size, digest = F.octet_length("payload"), F.sha2("payload", 256)
    repeated = landed(spark, rows.where(size >= least_bytes).select("page_id", digest.alias("seen"))
                      .groupBy("seen").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                      .where("n > 1").select("seen", "first_id"), "warc-repeated")
    rows = join_keys(rows, repeated, (size >= least_bytes) & (digest == F.col("seen")), "left")
    revisit = F.col("seen").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.select("page_id", "url", "payload", F.coalesce("captured", F.lit("19700101000000")).alias("captured"),
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("first_id")).alias("refers_to"))

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = shared_fs(folder)
        run = f"capture-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, entries, offset = None, [], 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{run}", compression=None)
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = member.compress(_record(row)) + member.flush()
                    out.write(data)
                    entries.append((url_key(row["url"]), row["captured"], row["page_id"], row["record_type"],
                                    offset, len(data)))
                    offset += len(data)
        finally:
            if out is not None:
                out.close()
        entries.sort(key=_order)
        for lo in range(0, len(entries), 100_000):
            part = entries[lo:lo + 100_000]
            keys, days, ids, kinds, offsets, lengths = (list(x) for x in zip(*part, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(days, pa.string()), pa.array(ids, pa.int64()),
                 pa.array(kinds, pa.string()), pa.array([run] * len(part)), pa.array(range(lo, lo + len(part))),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["url_key", "captured", "page_id", "record_type", "run", "place", "offset", "length"])

    return landed(spark, map_arrow(rows, write, ENTRY), "warc-runs"), folder


def _order(entry) -> tuple:
    key, day, page_id = entry[:3]
    return key.encode(), day, page_id is not None, page_id or 0


class LoserTree:
    """Merge of k sorted sequences: every inner node holds the loser of its
    match, so the next winner takes one match per level."""

    def __init__(self, sequences: list[list]):
        self.sequences, self.at = sequences, [0] * len(sequences)
        self.size = 1 << max(0, (len(sequences) - 1).bit_length())
        self.losers = [-1] * self.size
        self.winner = self._play(1)

    def _head(self, k: int):
        return self.sequences[k][self.at[k]]

    def _beats(self, a: int, b: int) -> bool:
        """-1 and ended sequences lose against all others; ties go to the first."""
        if a < 0 or a >= len(self.sequences) or self.at[a] >= len(self.sequences[a]):
            return False
        if b < 0 or b >= len(self.sequences) or self.at[b] >= len(self.sequences[b]):
            return True
        x, y = self._head(a), self._head(b)
        return x < y or (x == y and a < b)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        left, right = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (right, left) if self._beats(right, left) else (left, right)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self._beats(self.winner, -1):
            won = self.winner
            yield won, self.at[won]
            self.at[won] += 1
            node = (self.size + won) >> 1
            while node:
                if self._beats(self.losers[node], won):
                    won, self.losers[node] = self.losers[node], won
                node >>= 1
            self.winner = won


def merge_runs(spark: SparkSession, runs: DataFrame) -> DataFrame:
    """Landed global index: the entries with ``range_no`` and ``position``;
    ordered by both, captures are in order of URL key, timestamp and id."""
    key = F.col("url_key").cast("binary")
    dealt = runs.repartitionByRange(key, "captured", F.col("page_id").asc_nulls_first())

    def merge(batches):
        from pyspark import TaskContext

        whole = [b for b in batches if b.num_rows]
        if not whole:
            return
        table = pa.Table.from_batches(whole)
        run, place = table.column("run").to_pylist(), table.column("place").to_numpy()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("url_key", "captured", "page_id")), strict=True))
        slices: dict[str, list[int]] = {}
        for i, r in enumerate(run):
            slices.setdefault(r, []).append(i)
        names = sorted(slices)
        for n in names:  # the shuffle may hand blocks of a run over in any order
            slices[n].sort(key=place.__getitem__)
        tree = LoserTree([[_order(rows[i]) for i in slices[n]] for n in names])
        order = np.fromiter((slices[names[k]][j] for k, j in tree), dtype=np.int64, count=len(rows))
        table = table.take(pa.array(order))
        table = table.append_column("range_no", pa.array(np.full(len(rows), TaskContext.get().partitionId())))
        table = table.append_column("position", pa.array(np.arange(len(rows))))
        yield from table.to_batches(max_chunksize=100_000)

    return landed(spark, map_arrow(dealt, merge, ENTRY + ", range_no long, position long"), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Records at the places the index names: ``page_id, record_type,
    refers_to, url, payload, payload_bytes, stated_digest`` (of the full payload,
    also for revisits) and the index's ``url_key, captured, range_no,
    position``.  Each file is read front to back by the task that has it."""
    wanted = index.select("run", "offset", "length", "url_key", "captured", "range_no", "position") \
        .repartition("run").sortWithinPartitions("run", "offset")
    schema = ("page_id long, record_type string, refers_to long, url string, payload binary, payload_bytes long, "
              "stated_digest string, url_key string, captured string, range_no long, position long")
    names = ["page_id", "record_type", "refers_to", "url", "payload", "payload_bytes", "stated_digest"]
    shape = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                       ("stated_digest", pa.string()), ("url_key", pa.string()), ("captured", pa.string()),
                       ("range_no", pa.int64()), ("position", pa.int64())])

    def read(batches):
        store, root = shared_fs(folder)
        name, file, rows, size = None, None, [], 0
        try:
            for batch in batches:
                for e in batch.to_pylist():
                    if e["run"] != name:
                        if file is not None:
                            file.close()
                        name, file = e["run"], store.open_input_file(f"{root}/{e['run']}")
                    file.seek(e["offset"])
                    found = _parse(zlib.decompress(file.read(e["length"]), 31))
                    rows.append({n: found[n] for n in names} | {
                        n: e[n] for n in ("url_key", "captured", "range_no", "position")})
                    size += len(found["payload"] or b"")
                    if size > 16_000_000 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, shape)
                        rows, size = [], 0
        finally:
            if file is not None:
                file.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, shape)

    return map_arrow(wanted, read, schema)


def payload_digest() -> Column:
    """SHA-256 of the payload that was read, or the stated one of a revisit."""
    return F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("stated_digest"))
