"""Secret scan: patterns plus dictionary-primed novelty.

The patterns find assignments of a secret-like name, access key ids and long
hexadecimal runs.  Beyond them, every long token with a sensitive word in the
text around it (before or after, on any line), or between a private key's header
and its END line, is measured: zstandard, primed with a dictionary of common
identifiers, compresses the surrounding text with and without the token.  The
bytes the token adds, per character, tell random strings from words and code.
Other copies of the token are taken out of the surrounding text first, and all
copies in the text are reported when one is novel.

Spans are in code points, end exclusive, over whole texts.  Defined results: a
NULL text is empty and has no span; repeated rows are scanned alike; an empty
table gives no rows; other columns of the input are passed over.  A novel span
never overlaps one of the patterns.  A very long text is scanned whole, in time
that grows with its length (one row, at most Spark's 2 GiB).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import map_arrow, text_or_empty

# Fixed patterns of the base and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 or more characters; a run has one match
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN = 12
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "novel")

#: Words that make the text around them sensitive.
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|credential|private[_ -]?key|access[_-]?key|"
    r"bearer|signature|client[_-]?id|auth", re.I | re.A)
LEAST_NOVEL = 8
#: A candidate is a run without white space and quotes.  One of up to 15 characters, or with a sign that is
#: not in PLAIN, must hold a letter and a digit.
CANDIDATE = re.compile(r"[^\s\"'`]{8,}")
PLAIN = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.A)
MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])", re.A | re.S)
#: Well-known runs that are no secrets: addresses of pages and mail, dates and times.
PUBLIC = re.compile(r"\W*(?:(?:[a-z]+://|www\.)[^@?=]*|[\w.+-]+@[\w-]+\.[\w.-]+|\d{4}-\d\d-\d\d(?:T[\d:.]+(?:Z|[+-][\d:]+)?)?)\W*", re.A | re.I)
OUTER = ".,;:!?()[]{}<>&|*"
JOINTS = "=_/+-" + OUTER
#: The text from a key's header to its END line is sensitive as a whole.
HEADER = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z0-9 ]*-----")
FOOTER = re.compile("-----END ")
#: Added bytes per character from which a token is novel; characters of text on either side.
NOVELTY = 0.6
AROUND = 256

#: Identifiers that prime the compressor.
IDENTIFIERS = (
    "password passwd passphrase secret token access_token refresh_token api_key apikey client_id client_secret "
    "private_key public_key access_key credential credentials authorization bearer signature username hostname "
    "localhost database connection configuration environment settings getElementById addEventListener "
    "createElement querySelector constructor prototype toString valueOf undefined function return import export "
    "default public static final private protected abstract interface implements extends override "
    "java.lang.String System.out.println application/json content-type text/html http:// https:// www. .com .org "
    "self.assertEqual __init__ __name__ __main__ numpy pandas DataFrame exception traceback parameters arguments "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ example changeme placeholder your_key_here"
)


def core(token: str) -> str:
    """A token without the signs that join it to its neighbours."""
    return token.strip(JOINTS) or token


def without(text: str, lo: int, hi: int, token: str, least: int, most: int) -> str:
    """``text[lo:hi]`` without the characters of the copies of ``token`` that lie within ``least`` and ``most``."""
    parts, reach = [], len(token) - 1
    first, last = max(least, lo - reach), min(most, hi + reach)
    k = text.find(token, first, last)
    while k >= 0:
        parts.append(text[lo:max(lo, k)])
        lo = k + len(token)
        k = text.find(token, lo, last)
    return "".join([*parts, text[lo:hi]])


class Novelty:
    """Added compressed bytes per character of a string in its surroundings,
    from which other copies of the string are taken out."""

    def __init__(self, dictionary: str = IDENTIFIERS):
        import zstandard as zstd

        primed = zstd.ZstdCompressionDict(dictionary.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)
        self.zip = zstd.ZstdCompressor(level=6, dict_data=primed, write_checksum=False, write_content_size=False,
                                       write_dict_id=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        token = core(text[start:end])
        before = without(text, max(0, start - AROUND), start, token, 0, start)
        after = without(text, end, min(len(text), end + AROUND), token, end, len(text))
        whole = self.zip.compress((before + text[start:end] + after).encode("utf-8", "replace"))
        rest = self.zip.compress((before + after).encode("utf-8", "replace"))
        return (len(whole) - len(rest)) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns; the kind is its place in KINDS."""
    low = text.lower() if len(text) else ""
    found = []
    if any(n in low for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens with a sensitive word around them or a key
    header before.  Of a run that holds sensitive words, what follows each of
    them comes first and then the whole run."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    starts, found = [w[0] for w in words], []
    footers = [m.start() for m in FOOTER.finditer(text)]
    keys = [m.end() for m in HEADER.finditer(text)]
    # how far the body of this key or one before it reaches
    bodies = list(accumulate(((footers[k] if k < len(footers) else len(text))
                              for k in (bisect_left(footers, s) for s in keys)), max))

    def near(start: int, end: int) -> bool:
        k = bisect_left(starts, start - AROUND)
        while k < len(words) and words[k][0] < end + AROUND:
            s, e = words[k]
            if e <= start or end <= s and e <= end + AROUND:
                return True
            k += 1
        own = bisect_right(keys, start) - 1
        return own >= 0 and end <= bodies[own]

    def part(start: int, end: int) -> list[tuple[int, int]]:
        """The place without the signs around it, if that is long and mixed enough; signs
        of PLAIN at its ends are part of it."""
        while end > start and text[end - 1] in OUTER:
            end -= 1
        while start < end and text[start] in OUTER:
            start += 1
        own = text[start:end]
        return [(start, end)] if PLAIN.fullmatch(own) or len(own) >= LEAST_NOVEL and MIXED.match(own) else []

    for c in CANDIDATE.finditer(text):
        if not PLAIN.search(c[0]) and not MIXED.match(c[0]) or PUBLIC.fullmatch(c[0]):
            continue
        k = bisect_left(starts, c.start())
        for _, e in words[max(0, k - 1):bisect_left(starts, c.end())]:
            if e > c.start():
                found += part(e, c.end())
        if near(c.start(), c.end()):
            found += part(*c.span())
    return found


class Taken:
    """Disjoint spans in order; tells whether a place is free and takes it."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k == len(self.starts) or self.starts[k] >= end

    def take(self, start: int, end: int) -> None:
        k = bisect_right(self.ends, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Novel candidates, and wherever else in the text one of them stands."""
    found, taken = [], Taken((s, e) for s, _, e in base)
    for start, end in candidates(text):
        if taken.free(start, end) and novelty(text, start, end) >= NOVELTY:
            found.append((start, end))
            taken.take(start, end)
    if found:
        import ahocorasick

        tokens = ahocorasick.Automaton()
        for s, e in found:
            token = core(text[s:e])
            tokens.add_word(token, len(token))
        tokens.make_automaton()
        for last, n in tokens.iter(text):  # all copies in one pass over the text
            if taken.free(last + 1 - n, last + 1):
                found.append((last + 1 - n, last + 1))
                taken.take(*found[-1])
    return [(s, 3, e) for s, e in sorted(found)]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base`` and ``spans`` (arrays of kind, start, end), in order of
    start and kind; ``spans`` has the novel ones too."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        novelty = Novelty()
        shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        told = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
        for batch in batches:
            base, every = [], []
            for text in batch.column("text").to_pylist():
                own = base_spans(text)
                base.append(told(own))
                every.append(told(sorted(own + novel_spans(text, own, novelty))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, shape), pa.array(every, shape)],
                names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_arrow(rows, scan, f"doc_id {kind}, base {spans}, spans {spans}")


def spans_text(name: str):
    """Spans joined as ``kind:start:end``."""
    return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


