"""Statement parsing: each step is worked out once a row, with the results of a plain reading."""

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.operators import statements as ST

MAYO = "gc/Boleta gastos comunes mayo - 2024.pdf"


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_repeat_no_step_of_a_record(spark):
    """Filters moved below a projection repeated the text of the document, its period and the amounts in their condition."""
    pages = spark.createDataFrame([(MAYO, 1, "x")], "path string, page int, text string")
    rows = ST.positional_expenses(pages, keep=F.col("periodo") < F.lit("2025-01-01").cast("date")).where(
        (F.col("concepto_secundario") != F.col("item")) & (F.col("item") != "a"))
    plan = _optimized(rows)
    assert plan.count("array_join(") == 2  # the text of a document, the description of a record
    assert plan.count("as decimal(18,2))") == 2  # the two amounts
    assert plan.count(D.PERIOD_IN_NAME) <= 2  # of the pages that are kept, of the document


def test_outline_filters_repeat_no_step(spark):
    pages = spark.createDataFrame([(MAYO, 1, "x")], "path string, page int, text string")
    plan = _optimized(ST.outline_expenses(pages).where((F.col("concepto_secundario") != F.col("item")) & (F.col("valor_101") > 1)))
    assert plan.count("as decimal(18,2))") == 2 and plan.count(ST.AMOUNT_LINE) == 1 and plan.count(D.PERIOD_IN_NAME) == 1


def test_period_is_read_from_the_end_of_the_name(spark):
    names = ["mayo - 2024.pdf", "a/b mayo - 2024.pdf\n", "Mayo - 2024.pdf\r\n", "septiembre - 1999.pdf", "x" * 40 + "mayo - 2024.pdf",
             "x" * 7 + "septiembre - 2024.pdf", "x" * 7 + "septiembre - 2024.pdf\r\n", "y septiembre - 2024.pdf\r\n", "ñmayo - 2024.pdf",
             "mayo -2024.pdf", "mayo - 02024.pdf", "mayo - 2024.pdf.pdf", "mayo - 2024xpdf", "- 2024.pdf", " - 2024.pdf", "", "pdf", None,
             "enero - 2023.pdf mayo - 2024.pdf", "z" * 300 + " DICIEMBRE - 0001.pdf"]
    df = spark.createDataFrame([(n,) for n in names], "p string").select("p", D.period_from_name("p").alias("d"))

    def plain(name):
        m = re.search(r"(\w+) - (\d{4})\.pdf(?=(\r\n|[\n\r\x85  ])?\Z)", name or "")
        months = {x: i for i, x in enumerate(D.SPANISH_MONTHS, 1)}
        return date(int(m[2]), months[m[1].lower()], 1) if m and m[1].lower() in months else None

    assert {r.p: r.d for r in df.collect()} == {n: plain(n) for n in names}


def _plain_outline(text, reset):
    out, category, sub = [], "", ""
    for no, line in enumerate(text.replace("$", " $").split("\n")):
        m = re.match(r"^(.*?)\s+\$\s+([\d,.]+)\s+\$\s+([\d,.]+)$", line.strip())
        if not m:
            continue
        label, item = m[1], m[1]
        if label.isupper():
            category, sub = label, "" if reset else sub
            continue
        if label[:1].isdigit():
            item = sub = re.sub("^[0-9]+", "", label).strip(" ")
        out.append((no, category, sub, item))
    return out


@pytest.mark.parametrize("reset", [False, True])
def test_outline_reads_as_a_plain_reading(spark, reset):
    rng = random.Random(7)
    labels = ["AGUA", "LUZ Y GAS", "1Part 5", "22 Riego", "7", "Item 3", "item", "Ñandú", "ÑANDÚ", "$", "", "3AB"]
    pages = [(page, "\n".join(rng.choice(["{} $ 1,50 $ 2.000", "{} $1 $2", "{}", " {}\t$ 3 $ 4 ", "$ {}", ""]).format(rng.choice(labels))
                              for _ in range(n))) for page, n in enumerate([0, 1, 2, 5, 20, 64, 65, 700])]
    df = spark.createDataFrame([(MAYO, *p) for p in [*pages, (99, None)]], "path string, page int, text string")
    want = sorted((p, *r) for p, t in pages for r in _plain_outline(t, reset))
    for given in (df, ST.page_lines(df)):
        got = [(r.page, r.line_no, r.concepto_principal, r.concepto_secundario, r.item)
               for r in ST.outline_parse(given, reset_sub_on_category=reset).collect()]
        assert sorted(got) == want


def test_pages_of_orders_that_share_a_key(spark, tmp_path):
    """Pages are made of one row per order and date, but an outline page is one per priority and total too."""
    from tidepool.plans import text as T

    d = date(1998, 2, 3)
    orders = [(1, "O", 10.0, d, "1-URGENT"), (1, "P", 10.0, d, "2-HIGH"), (1, "O", 0.0, d, "1-URGENT"), (1, "O", -0.0, d, "1-URGENT"),
              (1, "O", 10.0, d, None), (2, "P", 5.0, d, "3-LOW"), (2, "P", 5.0, None, "3-LOW"), (3, "O", 7.0, d, "3-LOW")]
    lines = [(1, 8, 3, 2, 1.0, 9.0, "R", "F", d), (1, 7, 3, 1, 1.0, 9.5, "N", "O", d), (2, 7, 3, 2, 2.0, 1.0, "N", "O", d), (2, 6, 4, 3, 2.0, 1.0, "R", "O", d)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    outline, first, second = T.statement_pages(spark, str(tmp_path), outline=True, layouts=[1, 2])
    pages = sorted((r.path or "", r.page, r.text) for r in outline.collect())
    name = "statements/Boleta gastos comunes febrero - 1998.pdf"
    part, item = "1Part 7 $ 1,00 $ 9,50", "Item 8 $ 1,00 $ 9,00"

    def page(head, *of, key=1):
        return "\n".join([*head, *of, f"Nota pedido {key}"])

    low = ["Item 7 $ 1.2.3,4,5 $ 1,00", "3Part 6 $ 2,00 $ 1,00"]
    assert pages == sorted([
        (name, 1, page(["1-URGENT $ 10,00 $ 10,00"], part, item)),
        (name, 1, page(["2-HIGH $ 10,00 $ 10,00"], part, "Item 8 $ 1.2.3,4,5 $ 9,00")),
        (name, 1, page(["1-URGENT $ 0,00 $ 0,00"], part, part, item, item)),
        (name, 1, page([], part, item)),
        (name, 2, page(["3-LOW $ 5,00 $ 5,00"], *low, key=2)), ("", 2, page(["3-LOW $ 5,00 $ 5,00"], *low, key=2))])
    for n, pages in ((1, first), (2, second)):
        alone = T.positional_pages(spark, str(tmp_path), layout=n)
        assert pages.exceptAll(alone).isEmpty() and alone.exceptAll(pages).isEmpty() and pages.count() == 6
    text = {(r.path, r.page): r.text for r in first.collect()}["positional/1/Boleta gastos comunes febrero - 1998.pdf", 2]
    assert text.count("Part 7") == text.count("Part 8") == 5 and text.index("Part 8") > text.rindex("Part 7")
    alone = T.outline_pages(spark, str(tmp_path))
    assert outline.exceptAll(alone).isEmpty() and alone.exceptAll(outline).isEmpty()
