"""Registered queries against SQL and the pipeline against a brute-force run."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tidepool.llm import warc
from tidepool.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "pages", "labels", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    names, rows = [c[0] for c in want.description], want.fetchall()
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(rows, key=repr)


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.fixture(scope="module")
def small(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_op1_query(spark, small):
    got = QUERIES["op1_language_id"](spark, SF_SMALL).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(small)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, small[r["doc_id"]]))) and 0 <= r["score"] <= 1
    judged = [r for r in got if r["held_out"] and langs[r["doc_id"]] and len(small[r["doc_id"]]) > 200]
    assert judged and sum(r["lang_pred"] == langs[r["doc_id"]] for r in judged) >= 0.9 * len(judged)


def test_op3_query(spark, small):
    from tests.llm.test_llm_operators import ids_of

    ids = {i: np.array(ids_of(t) + [1], dtype="<u4") for i, t in small.items()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in QUERIES["op3_packing"](spark, SF_SMALL).collect():
        own = ids[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(own)
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for runs, ends in ((pieces, {i: len(x) for i, x in ids.items()}), (windows, None)):
        for k, own in runs.items():
            at = 0
            for start, length in sorted(own):
                assert start == at
                at += length
            assert at == ends[k] if ends else at <= 2048
    assert len(pieces) == len(ids)
    assert sum(map(len, ids.values())) / (2048 * len(windows)) > 0.95


def test_op4_query(spark, small):
    from tests.llm.test_llm_operators import ids_of

    at, want = 0, []
    for i in sorted(small):
        ids = np.array(ids_of(small[i]) + [0], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, SF_SMALL).collect()) == want


def test_op5_query(spark, small):
    from tests.llm.test_llm_operators import brute_components, brute_fingerprint

    ids = sorted(small)
    fps = [brute_fingerprint(small[i]) for i in ids]
    roots, least = brute_components(fps, 2), {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    want = [(i, f"{f:016x}", least[r]) for i, f, r in zip(ids, fps, roots, strict=True)]
    assert sorted(tuple(r) for r in QUERIES["op5_simhash"](spark, SF_SMALL).collect()) == want


def test_op6_query(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    want = []
    for i in sorted(pages):
        again = len(pages[i]) >= 100 and first[pages[i]] != i
        want.append((i, len(pages[i]), hashlib.sha256(pages[i]).hexdigest(), "revisit" if again else "response", first[pages[i]] if again else None))
    got = QUERIES["op6_warc"](spark, SF_SMALL).collect()
    assert sorted(tuple(r)[:5] for r in got) == want
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    history = [(warc.url_key(urls[r["page_id"]]).encode(), r["page_id"]) for r in sorted(got, key=lambda r: (r["range_no"], r["position"]))]
    assert history == sorted(history)  # one capture time per page id, ascending


def test_op9_query(spark, small):
    from tests.llm.test_llm_operators import brute_base

    kinds = ("assign", "access", "hex")
    for r in QUERIES["op9_secret_scan"](spark, SF_SMALL).collect():
        base = brute_base(small[r["doc_id"]])
        told = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == told


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, checked against plain Python."""
    from tests.llm.test_llm_operators import brute_components, brute_fingerprint, ids_of

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, stage = docs.columns, dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}
    a = stage["language ID"](spark, docs, SF_SMALL)
    assert a.columns == columns
    assert {r["doc_id"] for r in a.collect()} >= {i for i, r in rows.items() if r["lang"] and len(r["text"]) > 100}
    b = stage["exact dedup"](spark, docs, SF_SMALL)
    best = {}
    for i, r in rows.items():
        best[r["text"]] = max(i, best.get(r["text"], i))
    assert b.columns == columns and sorted(r["doc_id"] for r in b.collect()) == sorted(best.values())
    c = stage["SimHash near-dedup"](spark, docs, SF_SMALL)
    ids = sorted(rows)
    roots = brute_components([brute_fingerprint(rows[i]["text"]) for i in ids], 2)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    assert c.columns == columns and sorted(r["doc_id"] for r in c.collect()) == sorted(least.values())
    d = stage["mixing sources"](spark, c, SF_SMALL)
    assert d.columns == columns and {r["doc_id"] for r in d.collect()} <= set(least.values())
    e = stage["packing"](spark, c, SF_SMALL).collect()
    assert sum(r["length"] for r in e) == sum(len(ids_of(rows[i]["text"])) + 1 for i in least.values())


def test_language_stage_keeps_labelled_and_drops_unlikely_texts(spark):
    rnd = random.Random(7)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = [r["text"] for r in docs.where("lang IS NOT NULL AND length(text) > 300").orderBy("doc_id").limit(60).collect()]

    def shuffled(text):
        letters = [c for c in text if c.isalpha()]
        rnd.shuffle(letters)
        return "".join(letters.pop() if c.isalpha() else c for c in text)

    odd = ["это русский текст о погоде и жизни в большом городе", "qzx wvk pfd ghj klm nrt " * 20, "deadbeef cafe babe " * 40, "½ ² Ⅷ", None, ""]
    odd += [shuffled(t) for t in clean]
    more = spark.createDataFrame([(10**6 + k, t, None, "odd", 0) for k, t in enumerate(odd)], docs.schema)
    out = corpus_pipeline.language(spark, docs.unionByName(more), "")
    kept = {r["doc_id"] for r in out.collect()}
    assert out.columns == docs.columns
    labelled = [r["doc_id"] for r in docs.where("lang IS NOT NULL").collect()]
    assert sum(i in kept for i in labelled) >= 0.999 * len(labelled)
    assert not [odd[k] for k in range(len(odd)) if 10**6 + k in kept]


def test_stages_take_odd_rows_and_empty_tables(spark):
    from tests.llm.conftest import SCHEMA, odd_rows

    for docs in (spark.createDataFrame(odd_rows(), SCHEMA), spark.createDataFrame([], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            n = out.count()
            assert (n > 0) == (docs.count() > 0), name
            assert name == "packing" or out.columns == docs.columns


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert set(out.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    used = out.groupby("sequence_id")["length"].sum()
    assert (used <= 2048).all() and used.sum() / (2048 * len(used)) > 0.9
    assert np.all(out["length"] > 0)
