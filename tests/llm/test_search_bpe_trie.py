"""Ranked search, byte-level BPE and the prefix trie against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.llm import bpe, lexical, prefix_trie, word_merge
from tidepool.llm.queries import QUERIES, RANKS

# --- ranked lexical search --------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=10):
    """Rows of the ranking from its definition; documents and items are (id, text) pairs."""
    bags = [Counter(plain_terms(t)) for _, t in docs]
    n, length = sum(1 for b in bags if b), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for (i, _), b in zip(docs, bags, strict=True):
            m = 100 - 75 + 75 * b.total() * n // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                        for t in plain_terms(text) if b[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (*x[:2], x[2] or 0))[:top], 1)]
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the house and a garden"), (2, "THE house and a bird, the cat"), (3, None), (4, "!?"), (None, "nicht im haus"),
            (5, "a b a b"), (5, "a b a b"), (6, "été straße jouent"), (7, "unheard0f"), (8, "long words again the hund"),
            (9, "the house and a garden with trees where children play")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("rank", F.lit("clash"))


@pytest.mark.parametrize("cells, block_bytes", [(2_000_000, 4_000_000), (200, 60)])
def test_ranked_search(spark, docs, empty, items, monkeypatch, cells, block_bytes):
    monkeypatch.setattr(lexical, "CELLS", cells)
    got = lexical.ranked_search(spark, docs, items, block_bytes=block_bytes)
    want = plain_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert key(got.collect()) == key(want)
    for none in (lexical.ranked_search(spark, empty, items), lexical.ranked_search(spark, docs, items.limit(0)),
                 lexical.ranked_search(spark, docs.where("text is null"), items)):
        assert none.columns == got.columns and none.count() == 0


def test_search_query_over_whole_tables(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = plain_search([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items])
    assert key(QUERIES["op11_lexical_search"](spark, SF_SMALL).collect()) == key(want)


@pytest.mark.parametrize("seed", range(4))
def test_shared_sets_add_up_to_each_item(seed):
    rnd = random.Random(seed)
    items = [Counter(min(int(rnd.expovariate(0.1)), 60) for _ in range(rnd.randint(0, 30))) for _ in range(40)] + [Counter({3: 2})] * 3
    dag = lexical.mine(items)
    gains = np.array([rnd.randint(0, 10**9) for _ in range(61)])
    found = lexical.item_scores(dag, np.zeros(61, dtype=np.int64), np.arange(61), gains, 1)[:, 0]
    assert dag.items.tolist() == [k for k, c in enumerate(items) if c]
    assert found.tolist() == [sum(n * int(gains[t]) for t, n in c.items()) for c in items if c]
    atoms = sum(len(c) for c in items)
    assert len(dag.rounds) > 1 and len(dag.parts) + 2 * sum(len(r[0]) for r in dag.rounds) < atoms  # work is shared


# --- byte-level BPE ---------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_merge.read_ranks(RANKS), special_tokens={})


def odd_texts():
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    out = ["", " ", "it's  a\n\n test's\t", "x" * 3001, "ab" * 700 + "a", "日本語のテキスト" * 40, "ภาษาไทยไม่มีช่องว่าง" * 30, "🙂👩‍👩‍👧 ½²Ⅷ", "\x00\x1c\x85",
           "<|endoftext|>", "".join(rnd.choice(letters) for _ in range(4000)), "the " * 500, "aaaaabaaaabaaab" * 30,
           "".join(rnd.choice("etaoinshrdlu") for _ in range(2000))]
    parts = ["a", "the", " ", "  ", "\n", "é", "ß", "it's", "'ll", ",", "...", "12", " ", "日本", "!?", "ing", "tion", "ön"]
    return out + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(150)]


@pytest.mark.parametrize("long, rows, memory", [(64, 3_000_000, 150_000), (4, 3_000, 40)])
def test_bpe_equals_the_library(spark, library, monkeypatch, long, rows, memory):
    for name, value in (("LONG", long), ("ROWS_PER_QUERY", rows), ("IDS_PER_QUERY", rows // 10), ("WORDS", memory)):
        monkeypatch.setattr(word_merge, name, value)
    monkeypatch.setattr(bpe, "MAX_CHUNKS", memory)
    texts = odd_texts()
    merger = word_merge.WordMerger(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(word_merge, "CHARS_PER_STEP", 2_000)
    at = 0
    for lo, hi, ids, n in merger.runs(texts):
        assert lo == at and [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode_ordinary(t) for t in texts[lo:hi]]
        at = hi
    assert at == len(texts)


def test_one_place_at_a_time_equals_all_places(monkeypatch):
    rnd = random.Random(4)
    merger = word_merge.WordMerger(RANKS, public_tokenizers.PATTERN)
    pieces = ["".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 64))).encode() for _ in range(300)] + [b"a" * 64]
    one, many = (merger._contract(pieces, step) for step in (word_merge.WORD_STEP, word_merge.LONG_STEP))
    assert np.array_equal(one[0], many[0]) and np.array_equal(one[1], many[1])


def test_bpe_round_trip_of_odd_rows(spark, docs, empty, library):
    rows = docs.collect()
    want = key((r["doc_id"], tuple(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in rows)
    for out in (word_merge.decode(word_merge.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS),
                word_merge.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)):
        assert key((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out.collect()) == want
    assert word_merge.decode(word_merge.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_bpe_query_over_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = []
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert key(QUERIES["op12_byte_bpe"](spark, SF_SMALL).collect()) == key(want)


# --- prefix trie ------------------------------------------------------------------------------------------------------

def plain_trie(rows):
    """Rows of the trie from its definition; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in own.items()}
    path = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        path[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + t[h:])
    members = defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    saved, leaves = Counter(), Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not children[node]
    return [(min(own), len(n), min(members[n[:-1]]) if n else None, len(own), children[n], leaves[n], saved[n],
             hashlib.sha256(",".join(str(c) for c in sorted(own) if path[c] == n).encode()).hexdigest()) for n, own in members.items()]


TURNS = "conv_id long, turn long, role string, text string"


def odd_turns():
    rnd = random.Random(6)
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "é日本"), (2, 0, None, "x"), (3, 0, "user", ""), (-5, 1, "user", "neg"),
            (-100, 0, "a", "b"), (-100, 1, "a", "c"), (77_000, 0, "u", "far"), (77_001, 0, "u", "far")]
    for c in range(100, 420):
        if c != 300:
            rows += [(c, t, "user" if t % 2 == 0 else "assistant", rnd.choice(["yes", "no", "why so", ""]) if t else "hello")
                     for t in rng_turns(rnd)]
    rows += [(500 + k, t, "user", f"same {t}") for k in range(150) for t in range(3)]  # a group of copies
    rows += [(900, t, "user", f"long {t}") for t in range(300)] + [(901, t, "user", f"long {t}") for t in range(290)]
    return rows


def rng_turns(rnd):
    return rnd.sample(range(20), rnd.randint(1, 9))


@pytest.mark.parametrize("shard_rows, bits", [(200_000, 12), (3, 2)])
def test_prefix_trie(spark, monkeypatch, shard_rows, bits):
    monkeypatch.setattr(prefix_trie, "IDS_BITS", bits)
    rows = odd_turns()
    turns = spark.createDataFrame(rows, TURNS).withColumn("path", F.lit("clash")).repartition(5)
    got = prefix_trie.prefix_trie(spark, prefix_trie.with_shared_heads(spark, turns), shard_rows=shard_rows)
    assert [x.split()[0] for x in prefix_trie.NODE.split(", ")] == got.columns
    assert key(got.collect()) == key(plain_trie(rows))
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(spark, prefix_trie.with_shared_heads(spark, none)).count() == 0
    one = [(60, 0, "user", "alone")]
    got = prefix_trie.prefix_trie(spark, prefix_trie.with_shared_heads(spark, spark.createDataFrame(one, TURNS)))
    assert key(got.collect()) == key(plain_trie(one))


def test_trie_query_over_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert key(QUERIES["op13_prefix_trie"](spark, SF_SMALL).collect()) == key(plain_trie(rows))


def test_skeleton_holds_every_node_of_two_shards():
    rnd = random.Random(3)
    paths = sorted({b"".join(bytes([rnd.randint(0, 2)]) * prefix_trie.TURN for _ in range(rnd.randint(0, 8))) for _ in range(900)})
    cuts = sorted({paths[k][:n * prefix_trie.TURN] for k, n in ((50, 3), (51, 3), (120, 2), (200, 6), (250, 4))})
    trie, shards = prefix_trie.Skeleton.of(cuts), defaultdict(set)
    for p in paths:
        for n in range(0, len(p) + 1, prefix_trie.TURN):
            shards[p[:n]].add(sum(c <= p for c in cuts))
    for prefix, own in shards.items():
        at = 0
        for k in range(0, len(prefix), prefix_trie.TURN):
            at = trie.child.get((at, prefix[k:k + prefix_trie.TURN]), -1) if at >= 0 else -1
        assert len(own) == 1 or at >= 0
