"""Byte-level BPE by recursive DuckDB queries inside each Spark partition.

Spark deals the texts out; a task cuts its texts at blanks, remembers the ids of
the chunks it has met, and cuts new chunks into words by the vocabulary's pattern.
Their distinct words go to an in-process DuckDB (no files, one thread, bounded
memory).  There a word is a row per token position.
A recursive query joins neighbouring tokens with the merge table and contracts
each word's leftmost pair of least rank, until no pair is left.  Pairs of bytes
that nothing can come between are one token from the start.  Words of more
than ``LONG`` bytes are first cut where no token of the vocabulary holds the
two bytes side by side, and contract all places of their least rank in one
step if no pair made that way can rank before it; the ids are the same.  A
query stops after a number of steps that bounds its rows, and words that are
not finished go into the next one.

Decoding joins the ids of many texts with the vocabulary and puts the bytes
together by an ordered aggregate.

Defined results: a NULL or empty text has no ids and decodes to no bytes;
repeated rows and NULL ids of documents are kept as they are; an empty table
gives no rows; other columns are passed over.  Texts are read whole, up to
Spark's 2 GiB a row; a single word of a million letters of one kind of text
takes as many steps as it has distinct ranks, each over the whole word.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.bpe import ChunkEncoder
from tidepool.llm.common import map_arrow, text_or_empty

#: Words a Python worker remembers beside its chunks, bytes of new words in one query, rows that the steps of one query may make.
WORDS = 500_000
BYTES_PER_QUERY = 500_000
ROWS_PER_QUERY = 3_000_000
#: Most bytes of a word that isn't long; ids decoded, and characters cut into words, at once.
LONG = 64
NEVER = 2**31 - 1
IDS_PER_QUERY = 500_000
CHARS_PER_STEP = 2_500_000

#: One step for words: every row of a word that still has a pair, less the one that the contraction eats.
#: The least of a word packs rank, place and the next place (both under 64).
WORD_STEP = """
    SELECT word, pos, CASE WHEN pos = (low >> 6) & 63 THEN (low >> 12)::INTEGER ELSE tok END, step + 1, low IS NULL
    FROM f JOIN (SELECT word, min((merged::BIGINT << 12) | (pos << 6) | next_pos) AS low FROM f GROUP BY word) USING (word)
    WHERE low IS NULL OR pos <> low & 63"""

#: The same for long words.  Of places in a row the first, third, ... are contracted; a token that some pair of
#: lower rank could take up (not quiet) is made at one place at a time.
LONG_STEP = """
    SELECT word, pos, CASE WHEN joins THEN merged ELSE tok END, step + 1, least IS NULL
    FROM (SELECT *, lag(joins, 1, false) OVER (PARTITION BY word ORDER BY pos) AS eaten
          FROM (SELECT *, hit AND (nth - coalesce(max(CASE WHEN NOT hit THEN nth END) OVER prior, 0)) % 2 = 1
                          AND (quiet OR NOT coalesce(bool_or(hit) OVER prior, false)) AS joins
                FROM (SELECT *, coalesce(merged = least, false) AS hit FROM (SELECT *, min(merged) OVER (PARTITION BY word) AS least FROM f))
                WINDOW prior AS (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
    WHERE NOT eaten"""

CONTRACT = """
    WITH RECURSIVE t AS (
        SELECT word, pos, tok, 0 AS step, false AS done FROM words
        UNION ALL
        (WITH p AS (SELECT word, pos, tok, step, lead(tok) OVER w AS nxt, {place}
                    FROM t WHERE NOT done AND step < {steps} WINDOW w AS (PARTITION BY word ORDER BY pos)),
              f AS (SELECT p.*, merged, quiet FROM p LEFT JOIN merges ON pair = (tok::BIGINT << 32) | nxt)
         {step}))
    SELECT word, pos, tok, done FROM t WHERE done OR step = {steps} ORDER BY word, pos"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and rank of every token of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def duckdb_connection():
    """An in-process DuckDB of one thread that keeps everything in bounded memory."""
    import duckdb

    con = duckdb.connect(":memory:")
    for setting in ("threads = 1", "memory_limit = '1GB'", "temp_directory = ''"):
        con.execute(f"SET {setting}")
    return con


def gathered(flat: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``n`` values from ``begin`` on, one after the other."""
    upto = np.cumsum(n)
    return flat[np.arange(upto[-1] if len(n) else 0) + np.repeat(begin - (upto - n), n)]


def ask(con, query: str, **tables: pa.Table) -> pa.Table:
    for name, table in tables.items():
        con.register(name, table)
    return con.sql(query).to_arrow_table()


class WordMerger(ChunkEncoder):
    """Ids of whole texts; remembers the chunks between blanks, and their words, that it has met.

    The pattern must begin a match at every blank that stands between two
    characters other than white space, and never look across it."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.split = read_ranks(path), regex.compile(pattern).findall
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        rows, lowest = [], {}
        # of two bytes: the rank of both as a token, and the least rank of a token that holds them side by side
        self.rank2, self.reach = (np.full(1 << 16, NEVER, dtype=np.int32) for _ in range(2))
        for token, merged in self.ranks.items():
            for i in range(1, len(token)):
                a, b, two = self.ranks.get(token[:i]), self.ranks.get(token[i:]), token[i - 1] << 8 | token[i]
                self.reach[two] = min(self.reach[two], merged)
                if len(token) == 2:
                    self.rank2[two] = merged
                if a is not None and b is not None:
                    rows.append((a << 32 | b, merged))
                    lowest[a], lowest[b] = (min(lowest.get(x, merged), merged) for x in (a, b))
        pair, merged = zip(*rows, strict=True)
        self.con = duckdb_connection()
        self.con.register("rows", pa.table({"pair": pair, "merged": pa.array(merged, pa.int32()),
                                            "quiet": [lowest.get(m, m) >= m for m in merged]}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM rows")
        self._forget()
        self._forget_words()

    def _forget_words(self) -> None:
        self.number: dict[str, int] = {}
        self.word_flat, self.word_ends = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _rows(self, pieces: list[bytes]) -> dict[str, np.ndarray]:
        """A row per token position.  Two bytes that rank before every token that could
        reach across either end of them are one token from the start: nothing can come
        between them, so the contractions would join them all the same."""
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        two = blob[:-1].astype(np.int32) << 8 | blob[1:]
        two_or = lambda table: np.where(word[:-1] == word[1:], table[two], NEVER)
        own, reach = two_or(self.rank2), np.concatenate([[NEVER], two_or(self.reach), [NEVER]])
        first = np.flatnonzero((own < reach[:-2]) & (own < reach[2:]))
        tok, kept = self.byte[blob], np.ones(len(blob), dtype=bool)
        tok[first], kept[first + 1] = own[first], False
        return {"word": word[kept], "pos": pos[kept], "tok": tok[kept]}

    def _contract(self, pieces: list[bytes], step: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces one after the other, and how many each has."""
        left, ready = self._rows(pieces), []
        while len(left["word"]):
            steps = max(1, ROWS_PER_QUERY // len(left["word"]))
            place = "lead(pos) OVER w AS next_pos" if step is WORD_STEP else "row_number() OVER w AS nth"
            got = ask(self.con, CONTRACT.format(step=step, steps=steps, place=place), words=pa.table(left))
            done = got.column("done").to_numpy()
            word, pos, tok = (got.column(c).to_numpy() for c in ("word", "pos", "tok"))
            ready.append((word[done], tok[done]))
            left = {"word": word[~done], "pos": pos[~done], "tok": tok[~done]}
        word, tok = (np.concatenate(x) for x in zip(*ready, strict=True))
        return tok[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(pieces))

    def _pieces(self, word: bytes) -> list[bytes]:
        """A long word in parts that no token reaches across."""
        if len(word) <= LONG:
            return [word]
        b = np.frombuffer(word, dtype=np.uint8).astype(np.int64)
        cuts = np.flatnonzero(self.reach[b[:-1] << 8 | b[1:]] == NEVER) + 1
        return [word[i:j] for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(word)], strict=True)]

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        blobs = [w.encode() for w in words]
        pieces = [self._pieces(b) for b in blobs]
        per_word = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        first, flat = np.cumsum(per_word) - per_word, list(chain.from_iterable(pieces))
        size = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        whole = np.fromiter((self.ranks.get(b, -1) for b in blobs), dtype=np.int64, count=len(blobs))
        known = np.repeat(whole >= 0, per_word)  # a word that is a token needs no merging
        # ids of the whole words come first, then those of the queries; begin and n are each piece's place there
        ids, begin, n = [whole[whole >= 0].astype(np.int32)], np.zeros(len(flat), dtype=np.int64), np.zeros(len(flat), dtype=np.int64)
        begin[first[whole >= 0]], n[first[whole >= 0]] = np.arange(len(ids[0])), 1
        used = len(ids[0])
        for step, some in ((WORD_STEP, np.flatnonzero(~known & (size <= LONG))), (LONG_STEP, np.flatnonzero(~known & (size > LONG)))):
            for own in np.split(some, np.flatnonzero(np.diff(np.cumsum(size[some]) // BYTES_PER_QUERY)) + 1):
                if len(own):
                    tok, n[own] = self._contract([flat[k] for k in own.tolist()], step)
                    begin[own] = used + np.cumsum(n[own]) - n[own]
                    ids.append(tok)
                    used += len(tok)
        return gathered(np.concatenate(ids), begin, n), np.add.reduceat(n, first)

    def _learn(self, chunks: list[str], first: int) -> None:
        """Ids of new chunks: those of their words.  A chunk that begins a text is marked by a line feed."""
        words = [self.split(c[1:] if c[0] == "\n" else " " + c) for c in chunks]
        if len(self.number) > WORDS:
            self._forget_words()
        number, known = self.number, len(self.number)
        at = np.array([number.setdefault(w, len(number)) for own in words for w in own], dtype=np.int64)
        if len(number) > known:
            ids, n = self.word_ids(list(islice(reversed(number), len(number) - known))[::-1])
            self.word_ends = np.concatenate([self.word_ends, len(self.word_flat) + np.cumsum(n)])
            self.word_flat = np.concatenate([self.word_flat, ids])
        n = np.diff(self.word_ends)[at]
        flat, ends = gathered(self.word_flat, self.word_ends[at], n), np.cumsum([len(own) for own in words])
        ends = np.concatenate([[0], np.cumsum(n)])[ends]
        self._room(self.used + len(flat), first + len(chunks))
        self.flat[self.used:self.used + len(flat)] = flat
        self.length[first:first + len(chunks)] = np.diff(ends, prepend=0)
        self.start[first:first + len(chunks)] = self.used + ends - np.diff(ends, prepend=0)
        self.used += len(flat)

    def runs(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of texts: first, end, their ids one after the other, and how many each has."""
        lo, chars = 0, 0
        for k, text in enumerate(texts):
            chars += len(text)
            if chars >= CHARS_PER_STEP or k == len(texts) - 1:
                ids, n = self._step(texts[lo:k + 1])
                yield lo, k + 1, ids.view(np.int32), n
                lo, chars = k + 1, 0


class Decoder:
    """Bytes of id lists, by a join with the vocabulary and an ordered aggregate."""

    QUERY = "SELECT row, unhex(string_agg(piece, '' ORDER BY pos)) AS bytes FROM ids JOIN vocabulary USING (id) GROUP BY row"

    def __init__(self, path: str):
        ranks, self.con = read_ranks(path), duckdb_connection()
        self.con.register("given", pa.table({"id": pa.array(ranks.values(), pa.int32()), "piece": [t.hex() for t in ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")

    def __call__(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        row, parts = np.repeat(np.arange(len(n), dtype=np.int32), n), [[] for _ in n]
        for lo in range(0, len(ids), IDS_PER_QUERY):
            hi = min(len(ids), lo + IDS_PER_QUERY)
            got = ask(self.con, self.QUERY, ids=pa.table({"row": row[lo:hi], "pos": np.arange(hi - lo, dtype=np.int32), "id": ids[lo:hi]}))
            for k, blob in zip(got.column("row").to_pylist(), got.column("bytes").to_pylist(), strict=True):
                parts[k].append(blob)
        return pa.array([b"".join(p) for p in parts], pa.binary())


_MERGERS: dict[tuple[str, str], WordMerger] = {}


def merger_of(path: str, pattern: str) -> WordMerger:
    """The Python worker's merger, with the words that earlier tasks of the worker have learnt."""
    if (path, pattern) not in _MERGERS:
        _MERGERS[path, pattern] = WordMerger(path, pattern)
    return _MERGERS[path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, without special tokens.

    With ``decoded``, the task decodes its ids as well (as ``decode`` does) before it hands them on."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def write(batches):
        merger, decoder = merger_of(ranks_path, pattern), Decoder(ranks_path) if decoded else None
        for batch in batches:
            for lo, hi, ids, n in merger.runs(batch.column("text").to_pylist()):
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns = {"doc_id": batch.column("doc_id").slice(lo, hi - lo), "ids": pa.ListArray.from_arrays(ends, ids)}
                if decoded:
                    columns["decoded"] = decoder(ids, n)
                yield pa.RecordBatch.from_pydict(columns)

    return map_arrow(rows, write, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids of each row stand for."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def read(batches):
        decoder = Decoder(ranks_path)
        for batch in batches:
            lists = batch.column("ids")
            blobs = decoder(lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": lists, "decoded": blobs})

    return map_arrow(rows, read, f"doc_id {kind}, ids array<int>, decoded binary")


def ids_text(ids: str) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")
