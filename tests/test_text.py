import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.functions import strings as S
from tidepool.operators import statements as ST

OUTLINE = "\n".join([
    "CONSUMOS BÁSICOS $ 10,0 $ 20,0",
    "1Energía Eléctrica $ 3.386 $ 460.000",
    "Consumo Mayo $ 3.386 $ 460.000",
    "noise",
    "OTROS $ 1 $ 2",
    "Item B $ 5,5 $ 7.000,25",
])
NAME = "gc/Boleta gastos comunes mayo - 2024.pdf"


def _pages(spark, rows):
    return spark.createDataFrame(rows, "path string, page int, text string")


def test_string_predicates(spark):
    df = spark.createDataFrame([("ABC 1",), ("Abc",), ("123",), ("",), ("  $5",), ("12 Agua",)], "s string")
    got = df.select(
        "s", S.is_upper("s").alias("u"), S.starts_with_digit("s").alias("d"),
        S.starts_with_dollar("s").alias("dol"), S.strip_leading_number("s").alias("strip"),
    ).collect()
    m = {r.s: r for r in got}
    assert m["ABC 1"].u and not m["Abc"].u and not m["123"].u
    assert m["123"].d and not m[""].d
    assert m["  $5"].dol and not m[""].dol
    assert m["12 Agua"].strip == "Agua"


def test_amount_and_period_and_stem(spark):
    df = spark.createDataFrame([("$460.000,50", NAME), ("abc", "x/nope.pdf")], "a string, p string")
    r = df.select(
        S.parse_amount("a").alias("v"), D.period_from_name("p").alias("per"), S.file_stem("p").alias("stem")
    ).collect()
    assert r[0].v == Decimal("460000.50") and r[1].v is None
    assert r[0].per == dt.date(2024, 5, 1) and r[1].per is None
    assert r[0].stem == "Boleta gastos comunes mayo - 2024" and r[1].stem == "nope"
    t = spark.range(1).select(S.format_amount(F.lit(1234.5)).alias("t")).collect()[0].t
    assert t == "1.234,50"


def test_outline_fixture(spark):
    lines = ST.page_lines(_pages(spark, [(NAME, 1, OUTLINE)]))
    got = ST.outline_expenses(lines).orderBy("valor_comunidad").collect()
    rows = [(r.concepto_principal, r.concepto_secundario, r.item, r.valor_101, r.valor_comunidad) for r in got]
    assert sorted(rows) == sorted([
        ("CONSUMOS BÁSICOS", "Energía Eléctrica", "Energía Eléctrica", Decimal("3386.00"), Decimal("460000.00")),
        ("CONSUMOS BÁSICOS", "Energía Eléctrica", "Consumo Mayo", Decimal("3386.00"), Decimal("460000.00")),
        ("OTROS", "Energía Eléctrica", "Item B", Decimal("5.50"), Decimal("7000.25")),
    ])
    assert all(r.periodo == dt.date(2024, 5, 1) for r in got)
    reset = ST.outline_expenses(lines, reset_sub_on_category=True).where("item = 'Item B'").collect()[0]
    assert reset.concepto_secundario == ""


def test_outline_pages_need_no_shuffle(spark):
    long = "\n".join(["A $ 1 $ 1", "1Sub $ 1 $ 1", *[f"Item{i} $ 1 $ 2" for i in range(200)], "B $ 1 $ 1", "Last $ 1 $ 2"])
    pages = _pages(spark, [(NAME, 1, OUTLINE), (NAME, 2, long), (NAME, 2, OUTLINE), (NAME, 3, None), (NAME, 4, "")])
    got = ST.outline_expenses(pages)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = [(r.concepto_principal, r.concepto_secundario, r.item) for r in got.collect()]
    assert rows.count(("CONSUMOS BÁSICOS", "Energía Eléctrica", "Consumo Mayo")) == 2  # a repeated page is read by itself
    assert ("A", "Sub", "Item199") in rows and ("B", "Sub", "Last") in rows and len(rows) == 3 + 3 + 1 + 200 + 1
    reset = ST.outline_expenses(pages, reset_sub_on_category=True).where("item = 'Last'").collect()[0]
    assert (reset.concepto_principal, reset.concepto_secundario) == ("B", "")
    assert ST.outline_expenses(pages, dedupe=True).count() == len(set(rows))


def test_swap_label_item(spark):
    df = spark.createDataFrame([("Riego Abril", "x"), ("Luz", "y"), (None, "z")], "concepto_secundario string, item string")
    got = ST.swap_label_item(df, "Riego Abril", "Aguas").collect()
    assert [tuple(r) for r in got] == [("Aguas", "Riego Abril"), ("Luz", "y"), (None, "z")]


def test_outline_rejects(spark):
    lines = ST.page_lines(_pages(spark, [("nope.pdf", 1, "Item $ 1 $ 2"), (NAME, 1, "Item $ 1.2.3,4,5 $ 2")]))
    reasons = sorted(r.reject_reason for r in ST.outline_rejects(lines).collect())
    assert reasons == ["no period in file name", "unreadable amount"]


POSITIONAL = ["x", "CONSUMOS BÁSICOS", "h1", "h2", "1", "Enel", "Luz Mayo", "$3.386", "$460.000",
              "2", "Aguas", "Agua", "2908569-2", "$10", "$20,5", " ", "tail"]


def test_positional_fixture(spark):
    # the document spans two pages; the page boundary is a line boundary
    pages = _pages(spark, [(NAME, 1, "\n".join(POSITIONAL[:6])), (NAME, 2, "\n".join(POSITIONAL[6:]))])
    lines = ST.page_lines(pages, space_before_dollar=False)
    got = ST.positional_parse(lines).orderBy("record").collect()
    rows = [(r.concepto_secundario, r.item, r.cuenta, r.valor_101, r.valor_comunidad, r.reject_reason) for r in got]
    assert rows == [
        ("Enel", "Luz Mayo", None, Decimal("3386.00"), Decimal("460000.00"), None),
        ("Aguas", "Agua", "2908569-2", Decimal("10.00"), Decimal("20.50"), None),
    ]
    b = ST.section_bounds(lines).collect()[0]
    assert (b.start, b.end) == (5, 16)


def test_positional_long_record_over_pages(spark):
    more = [f"word{i}" for i in range(40)]
    doc = ["CONSUMOS BÁSICOS", "a", "b", "1", "Co", "Desc", *more, "acct", "$1", "$2", "2", "Co2", "D2", "$3", "$4", " "]
    pages = [(NAME, k, "\n".join(doc[i:i + 7])) for k, i in enumerate(range(0, len(doc), 7))]
    # tests read the pages in another order than the document's
    got = ST.positional_parse(_pages(spark, pages[::-1]), continuation_pattern="^word").orderBy("record").collect()
    assert [r.reject_reason for r in got] == [None, None]
    assert got[0].item == " ".join(["Desc", *more]) and got[0].cuenta == "acct"
    assert (got[1].concepto_secundario, got[1].item, got[1].valor_comunidad) == ("Co2", "D2", Decimal("4.00"))


def test_repeated_pages_do_not_multiply_lines(spark):
    page = (NAME, 1, "\n".join(str(i) for i in range(12)))
    doc = ST.numbered_lines(_pages(spark, [page, page, (NAME, 2, None), ("other", 1, "")]))
    assert sorted(r.gidx for r in doc.where(F.col("path") == NAME).collect()) == list(range(1, 25))
    assert doc.where("path = 'other'").count() == 1


def test_positional_continuations_and_rejects(spark):
    doc = ["CONSUMOS BÁSICOS", "a", "b",
           "1", "Co", "Desc", "Prov", "123-4", "26-10-2023", "$1", "$2",
           "x2", "Co2", "D2", "$3", "$4",
           "3", "Co3", "D3", "$5", " "]
    lines = ST.page_lines(_pages(spark, [(NAME, 1, "\n".join(doc))]), space_before_dollar=False)
    got = {r.record: r for r in ST.positional_parse(lines, continuation_values=["Prov"]).collect()}
    assert got[0].item == "Desc Prov 26-10-2023" and got[0].cuenta == "123-4" and got[0].reject_reason is None
    assert got[1].reject_reason == "record number is not an integer"
    assert got[2].reject_reason == "incomplete record"
    two = ["CONSUMOS BÁSICOS", "a", "b", "7", "s1", "s2", "s3", "Co", "D", "$1", "$2", "Nro", "Co2", "D2", "$3", "$4", " "]
    lines2 = ST.page_lines(_pages(spark, [(NAME, 1, "\n".join(two))]), space_before_dollar=False)
    got2 = ST.positional_expenses(lines2, lead_lines=ST.layout2_lead_lines(), number_required=False).collect()
    assert sorted((r.concepto_secundario, r.item) for r in got2) == [("Co", "D"), ("Co2", "D2")]


def test_adjusted_report(spark):
    cols = "periodo date, concepto_principal string, concepto_secundario string, item string, " \
           "valor_101 decimal(18,2), valor_comunidad decimal(18,2)"
    a = spark.createDataFrame([(dt.date(2024, 5, 1), "C", "Aguas Andinas", "x", Decimal(1), Decimal(5))], cols)
    b = spark.createDataFrame([(dt.date(2024, 4, 1), "C", "Telefonía e Internet", "y", Decimal(1), Decimal(2)),
                               (dt.date(2024, 4, 1), "C", None, "z", Decimal(1), Decimal(2))], cols)
    out = ST.adjusted_expenses([a, b], {"Aguas Andinas": "Agua"}, ["Telefonía e Internet"]).collect()
    assert [(r.concepto_secundario, r.item) for r in out] == [("Agua", "x")]
