"""What a Python worker holds at once: batches, tokenizer calls, idle memory."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.test_llm_operators import TOKENIZER
from tidepool.llm import bpe, common, langid, packing

BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_the_tokenizer_gets_a_bounded_number_of_chunks(monkeypatch):
    sizes, ids_of = [], bpe.ChunkEncoder._ids
    monkeypatch.setattr(bpe, "CHUNKS_PER_CALL", 50)
    monkeypatch.setattr(bpe.ChunkEncoder, "_ids", lambda self, texts: sizes.append(sum(t.count(" ") + 1 for t in texts)) or ids_of(self, texts))
    encoder = bpe.ChunkEncoder(TOKENIZER)
    texts = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(60)] + ["", " ", "\n a  b"]
    ids, n = encoder.encode(texts, 1)
    assert max(sizes) <= 60 and len(sizes) > 20
    want = [[*encoder.tok.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_pieces_come_from_small_batches_whatever_the_steps(spark, monkeypatch):
    texts = ["", None, "x" * 9, "ä ö " * 400, "one two\nthree  four " * 200]
    docs = spark.createDataFrame([(k if k % 7 else None, texts[k % 5]) for k in range(40)], "doc_id long, text string").coalesce(1)
    whole = sorted(map(str, packing.token_pieces(docs, TOKENIZER).collect()))
    monkeypatch.setattr(packing, "CHARS_AT_ONCE", 3_000)
    assert sorted(map(str, packing.token_pieces(docs, TOKENIZER).collect())) == whole

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"length": [1], "rows": [batch.num_rows]})

    monkeypatch.setattr(common, "BATCH_BYTES", 1 << 16)
    before = spark.conf.get(BATCH_KEY)
    wide = spark.range(0, 500, 1, 1).select(F.repeat(F.lit("abcd"), 250).alias("t"))
    seen = packing.pack(spark, wide.mapInArrow(rows, "length long, rows long")).collect()
    assert sum(r["rows"] for r in seen) == 500 and max(r["rows"] for r in seen) < 100
    assert spark.conf.get(BATCH_KEY) == before


def test_memory_is_given_back_and_quantiles_start_no_worker(spark, monkeypatch):
    blocks = [np.ones(3_000) for _ in range(200)]
    del blocks
    common.release_memory()
    rows = spark.range(9).select(F.when(F.col("id") < 6, "a").alias("lang"), F.col("id").cast("double").alias("v"))
    rows = rows.where("lang IS NOT NULL")

    def no_rows(*args, **options):
        raise AssertionError("rows from the driver go through a Python worker")

    monkeypatch.setattr(type(spark), "createDataFrame", no_rows)
    assert langid.quantiles(spark, rows, "lang", "v", [0.0, 0.5]) == {"a": [0.0, 2.5]}
