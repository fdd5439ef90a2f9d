import numpy as np

import corpus_pipeline
from tidepool.llm import langid


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    of = {"a": np.round(rng.normal(size=3_001), 2), "b": rng.normal(size=10), "c": np.array([2.5])}
    rows = spark.createDataFrame([(k, float(v)) for k, vs in of.items() for v in vs], "lang string, v double").repartition(5)
    got = langid.quantiles(spark, rows, "lang", "v", [0.001, 0.5])
    assert got.keys() == of.keys()
    for k, vs in of.items():
        np.testing.assert_allclose(got[k], np.quantile(vs, [0.001, 0.5]), rtol=1e-12)
    assert langid.quantiles(spark, rows.limit(0), "lang", "v", [0.5]) == {}


def test_pipeline_model_and_bounds_read_all_labelled_rows(spark, docs, monkeypatch):
    def no_sample(*args):
        raise AssertionError("a sample of the labelled rows")

    monkeypatch.setattr(langid, "drawn", no_sample)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
