"""Token ids of texts by a public tokenizer file, with a memory of chunks.

A text is cut before every blank that stands between two characters other
than white space.  The byte-level pattern always starts a new piece at such a
blank and never looks across it, so the ids of a text are the ids of its
chunks, one after the other.  Each chunk goes through the tokenizer once; its
ids are then kept for all further texts of the Python worker.  When the memory
is full, the chunks that were met more than once stay.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A blank between two characters that are not white space.
CUT = re.compile(r" (?=\S)(?<!\s )")

#: Chunks kept per Python worker, chunks in one tokenizer call, characters in one step.
MAX_CHUNKS = 500_000
CHUNKS_PER_CALL = 1_000
CHARS_PER_STEP = 4_000_000


class ChunkEncoder:
    """``encode(texts)`` equals the tokenizer's own ids, text by text."""

    max_chunks: int | None = None
    step_chars: int | None = None

    def __init__(self, path: str, max_chunks: int | None = None, step_chars: int | None = None):
        self.max_chunks, self.step_chars = max_chunks, step_chars
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.token_bytes = np.zeros(self.size, dtype=np.int64)
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.token_bytes[i] = len(token)  # the byte alphabet writes one character per byte
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.length = np.zeros(1 << 14, dtype=np.int64)
        self.hits = np.zeros(1 << 14, dtype=np.int32)
        self.used = 0

    def _bound(self) -> int:
        return self.max_chunks or MAX_CHUNKS

    def _shrink(self) -> None:
        """Keep the chunks met more than once, at most half the bound, the most frequent first."""
        n = len(self.code)
        hits = self.hits[:n]
        least = max(2, int(np.partition(hits, n - self._bound() // 2)[n - self._bound() // 2]) + 1)
        kept = np.flatnonzero(hits >= least)
        words = list(self.code)
        begin, length = self.start[kept], self.length[kept]
        upto = np.cumsum(length)
        total = int(upto[-1]) if len(kept) else 0
        flat = self.flat[np.arange(total) + np.repeat(begin - (upto - length), length)]
        self._forget()
        self.code = {words[i]: k for k, i in enumerate(kept.tolist())}
        self._room(total, len(kept))
        self.flat[:total], self.used = flat, total
        self.start[:len(kept)], self.length[:len(kept)] = upto - length, length

    def _room(self, ids: int, chunks: int) -> None:
        if ids > len(self.flat):
            self.flat = np.resize(self.flat, max(ids, 2 * len(self.flat)))
        if chunks > len(self.start):
            old, size = len(self.hits), max(chunks, 2 * len(self.start))
            self.start, self.length = np.resize(self.start, size), np.resize(self.length, size)
            self.hits = np.resize(self.hits, size)
            self.hits[old:] = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str], first: int) -> None:
        """Ids of new chunks.  A chunk that begins a text is marked by a line feed."""
        heads = [i for i, c in enumerate(chunks) if c[0] == "\n"]
        inner = [i for i, c in enumerate(chunks) if c[0] != "\n"] if heads else range(len(chunks))
        own = [chunks[i] for i in inner]
        size = pc.binary_length(pa.array(own, pa.string())).to_numpy() + 1
        # call by call: the tokenizer's own record of an id takes far more room than the id
        calls = [np.array(self._ids([" " + " ".join(own[k:k + CHUNKS_PER_CALL])])[0], dtype=np.uint32)
                 for k in range(0, len(own), CHUNKS_PER_CALL)]
        ids = np.concatenate([np.zeros(0, dtype=np.uint32), *calls])
        del calls
        # each id stands for a known number of bytes, so the chunks' ends are found again among the ids
        ends, reach = np.cumsum(size), np.cumsum(self.token_bytes[ids])
        upto = np.searchsorted(reach, ends) + 1
        if not np.array_equal(reach[upto - 1], ends):
            raise ValueError("the tokenizer joins what the cut keeps apart: it is not byte-level")
        front = [np.array(x, dtype=np.uint32) for k in range(0, len(heads), CHUNKS_PER_CALL)
                 for x in self._ids([chunks[i][1:] for i in heads[k:k + CHUNKS_PER_CALL]])]
        length = np.zeros(len(chunks), dtype=np.int64)
        begin = np.zeros(len(chunks), dtype=np.int64)
        length[inner], begin[inner] = np.diff(upto, prepend=0), upto - np.diff(upto, prepend=0)
        length[heads] = [len(x) for x in front]
        begin[heads] = len(ids) + np.cumsum(length[heads]) - length[heads]
        ids = np.concatenate([ids, *front])
        self._room(self.used + len(ids), first + len(chunks))
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[first:first + len(chunks)] = self.used + begin
        self.length[first:first + len(chunks)] = length
        self.used += len(ids)

    def _codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk codes of all texts and the number of chunks of each.

        Arrow splits at every blank and numbers the distinct pieces.  A text
        with a piece that is empty or has white space at an end was cut in a
        wrong place; it is cut again by the pattern.
        """
        code = self.code
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        numbered = split.values.dictionary_encode()
        pieces, number = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        trimmed = pc.utf8_trim_whitespace(numbered.dictionary)
        wrong = pc.or_(pc.not_equal(trimmed, numbered.dictionary), pc.equal(trimmed, "")).to_numpy(zero_copy_only=False)
        offsets = split.offsets.to_numpy()
        counts, first = np.diff(offsets).astype(np.int64), offsets[:-1]
        again = np.flatnonzero(np.maximum.reduceat(wrong[number], first)) if len(texts) else []
        own = np.ones(len(number), dtype=bool)
        for k in again:
            own[offsets[k]:offsets[k + 1]] = False
        table = np.zeros(len(pieces), dtype=np.int64)
        if len(again):
            used = np.zeros(len(pieces), dtype=bool)
            used[number[own]] = True
            at = np.flatnonzero(used).tolist()
            table[at] = [code.setdefault(pieces[i], len(code)) for i in at]
        else:
            table[:] = [code.setdefault(p, len(code)) for p in pieces]
        codes = table[number]
        heads = [i for i in range(len(texts)) if own[first[i]]]
        codes[first[heads]] = [code.setdefault("\n" + pieces[number[first[i]]], len(code)) for i in heads]
        if not len(again):
            return codes, counts
        parts = np.split(codes, offsets[1:-1])
        for k in again:
            chunks = CUT.split(texts[k])
            chunks[0] = "\n" + chunks[0]
            parts[k] = np.array([code.setdefault(c, len(code)) for c in chunks], dtype=np.int64)
            counts[k] = len(chunks)
        return np.concatenate(parts), counts

    def _step(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.code) > self._bound():
            self._shrink()
        known = len(self.code)
        at, counts = self._codes(texts)
        if len(self.code) > known:
            self._learn(list(islice(reversed(self.code), len(self.code) - known))[::-1], known)
        self.hits[:len(self.code)] += np.bincount(at, minlength=len(self.code)).astype(np.int32)
        begin = self.start[at]
        length = self.length[at]
        upto = np.cumsum(length)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.flat[np.arange(total) + np.repeat(begin - (upto - length), length)]
        last = np.cumsum(counts) - 1
        ends = upto[last] if len(upto) else np.zeros(0, dtype=np.int64)
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids as one array and the number of ids of each text, ``end_id``
        (if given) included at the end of each."""
        flats, sizes, step, chars = [], [], [], 0
        for k, text in enumerate(texts):
            step.append(text)
            chars += len(text)
            if chars >= (self.step_chars or CHARS_PER_STEP) or k == len(texts) - 1:
                ids, n = self._step(step)
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(n), end_id)
                    n = n + 1
                flats.append(ids)
                sizes.append(n)
                step, chars = [], 0
        if not flats:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        return np.concatenate(flats), np.concatenate(sizes)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file, which every executor must have."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
