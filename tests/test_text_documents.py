import pytest
from pyspark.sql import functions as F

from tidepool.functions import strings as S
from tidepool.operators import statements as ST

MAYO, JUNIO = (f"gc/Boleta gastos comunes {m} - 2024.pdf" for m in ("mayo", "junio"))
DOC = ["x", "CONSUMOS BÁSICOS", "h", "CONSUMOS BÁSICOS", "h1", "h2", "1", "Enel", "Luz", "$3.386", "$460.000",
       "2", "Aguas", "Agua", "2908569-2", "01-02-2024", "$10", " $20,5", "3", "Gas", " ", "tail", "CONSUMOS BÁSICOS", " "]


def _pages(spark):
    rows = [(MAYO, k, "\n".join(DOC[i:i + 4])) for k, i in enumerate(range(0, len(DOC), 4))]
    rows += [(JUNIO, 1, "\n".join(DOC[:11])), (JUNIO, 1, "\n".join(DOC[11:])), (JUNIO, 0, None), (None, 1, "\n".join(DOC)),
             ("no end.pdf", 1, "\n".join(DOC[:9])), ("no marker.pdf", 1, "a\n \nb"), ("empty.pdf", 1, "CONSUMOS BÁSICOS\n "),
             ("nothing.pdf", 1, None), ("blank first.pdf", 1, " \nCONSUMOS BÁSICOS\na\nb\n1\nC\nD\n$1\n$2\n ")]
    return spark.createDataFrame(rows, "path string, page int, text string").repartition(1)


@pytest.mark.parametrize("chars", [0, 60, 1 << 20])
def test_short_and_long_documents_read_alike(spark, monkeypatch, chars):
    monkeypatch.setattr(ST, "ROW_CHARS", chars)  # 0: all documents page by page
    bounds = {r.path: (r.start, r.end) for r in ST.section_bounds(_pages(spark)).collect()}
    assert bounds == {MAYO: (7, 21), JUNIO: (7, 21), "empty.pdf": (4, 2), "blank first.pdf": (5, 10)}
    got = sorted((r.path, r.record, r.concepto_secundario, r.item, r.cuenta, r.reject_reason) for r in ST.positional_parse(_pages(spark)).collect())
    of = [(0, "Enel", "Luz", None, None), (1, "Aguas", "Agua 01-02-2024", "2908569-2", None), (2, "Gas", "", None, "incomplete record")]
    assert [r for r in got if r[0] == MAYO] == [(MAYO, *r) for r in of]
    assert [r for r in got if r[0] == JUNIO] == [(JUNIO, *r) for r in of]
    assert {r[0] for r in got} == {MAYO, JUNIO, "blank first.pdf"}


def test_short_documents_meet_once(spark):
    plan = ST.positional_parse(_pages(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan  # one exchange of the pages by document, nothing landed between


def test_strip_takes_all_white_space(spark):
    some = ["  \t$5 \r", "\x85a b　", " ", "", "x"]
    df = spark.createDataFrame([(s,) for s in some], "s string").select("s", S.py_strip("s").alias("t"),
                                                                        F.regexp_replace("s", r"(?U)^\s+|\s+$", "").alias("u")).collect()
    assert all(r.t == r.u == r.s.strip() for r in df)
