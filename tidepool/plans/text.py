"""Statement-text queries.

Statement pages are generated *from the driver tables with Spark* so the
parsers run on data that grows with the tables and the oracle is the plain
lineitem/orders query:

* outline pages: one page per order (file per order month), a header line
  ``<priority> $ total $ total``, one amount line per line item (odd line
  numbers digit-led -> sub-category), a ``LATE LINES`` header before items
  with line number > 4, a note line, and an unreadable amount on line 2 of
  orders with status ``P`` (-> rejects);
* positional pages: one document per order, page 1 = preamble and section
  marker, page 2 = one record per line item (number, company = supplier,
  description = part, account line for return flag ``R``, a date
  continuation line for line status ``F``, two ``$`` amount lines), the
  single-blank end line and a tail.  Record number ``x3`` on line 3 of
  orders with status ``P`` (-> rejects).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.functions import strings as S
from tidepool.operators import shape as SH
from tidepool.operators import statements as ST
from tidepool.plans.registry import register
from tidepool.session import read_table, scratch_path
from tidepool.sinks.tables import write_path

# SQL helpers for the oracles -------------------------------------------------
_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in D.SPANISH_MONTHS) + "]"
_OUTLINE_PATH_SQL = (
    f"'statements/Boleta gastos comunes ' || {_MONTHS_SQL}[month(o.o_orderdate)] || ' - ' "
    "|| CAST(year(o.o_orderdate) AS VARCHAR) || '.pdf'"
)
_POS_PATH_SQL = (
    f"'positional/' || CAST(o.o_orderkey AS VARCHAR) || '/Boleta gastos comunes ' "
    f"|| {_MONTHS_SQL}[month(o.o_orderdate)] || ' - ' || CAST(year(o.o_orderdate) AS VARCHAR) || '.pdf'"
)


def _statement_name(prefix, d):
    return F.concat(
        prefix, F.lit("Boleta gastos comunes "), D.month_name(d), F.lit(" - "), F.year(d).cast("string"), F.lit(".pdf")
    )


def _order_lines(spark, sf):
    o = read_table(spark, sf, "orders")
    li = read_table(spark, sf, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def _landed(spark, df, name):
    """Land generated pages as a parquet table (as extracted statements would
    land in storage) and read them back: the parsers then start from a file
    scan instead of re-deriving the pages in every branch of their plan.
    Texts repeat much, so zstandard takes less disk than the default."""
    path = scratch_path(spark, name)
    write_path(df, path, options={"compression": "zstd"})
    return spark.read.parquet(path)


def outline_pages(spark, sf):
    """``(path, page, text)`` outline statement pages, one per order."""
    return statement_pages(spark, sf, outline=True)[0]


def positional_pages(spark, sf, layout: int = 1):
    """``(path, page, text)`` positional statement documents, two pages each."""
    return statement_pages(spark, sf, layouts=[layout])[0]


def statement_pages(spark, sf, outline: bool = False, layouts=()):
    """The outline pages, if asked for, and the positional pages of each of ``layouts``: all
    from one landed table with a row per order, as all are made of the lines of an order."""
    docs = _landed(spark, _documents(spark, sf, outline, layouts), "statement_pages")
    found = []
    if outline:
        found.append(docs.select(F.col("outline_path").alias("path"), F.col("o_orderkey").alias("page"), F.explode("outline").alias("text")))
    for n in layouts:  # both pages of an order from its one row
        pages = F.array(*[F.struct(F.lit(k).alias("page"), F.col(t).alias("text")) for k, t in ((1, "first"), (2, f"second_{n}"))])
        found.append(docs.select("path", F.inline(pages)))
    return found


def _documents(spark, sf, outline, layouts):
    """One row per order and date: ``(outline_path, o_orderkey, outline)`` with the texts of its outline pages, and
    ``(path, first, second_1, ...)`` with the texts of its positional pages, the second for each layout."""
    x = _order_lines(spark, sf)
    lines = {"outline": _outline_line()} if outline else {}
    lines |= {f"second_{n}": _positional_record(n) for n in layouts}
    # lines are made before they are collected: within the aggregate, their expressions would not be compiled
    x = x.select("o_orderkey", "o_orderdate", *[line.alias(k) for k, line in lines.items()])
    x = x.groupBy("o_orderkey", "o_orderdate").agg(*[F.sort_array(F.collect_list(k)).alias(k) for k in lines])
    d, key = F.col("o_orderdate"), F.col("o_orderkey").cast("string")
    columns = []
    if outline:
        columns += [_statement_name(F.lit("statements/"), d).alias("outline_path"), "o_orderkey", _outline_texts("outline", key).alias("outline")]
    if layouts:
        columns += [_statement_name(F.concat(F.lit("positional/"), key, F.lit("/")), d).alias("path"),
                    F.lit("Edificio Central\nCONSUMOS BÁSICOS\nEmpresa\nDetalle").alias("first")]
    columns += [F.concat(F.array_join(f"second_{n}.t", "\n"), F.lit("\n \nTotal\nfin")).alias(f"second_{n}") for n in layouts]
    return x.select(*columns)


def _outline_line():
    """Line of an outline page, after what tells its page and its place."""
    bad = (F.col("o_orderstatus") == "P") & (F.col("l_linenumber") == 2)
    label = F.when(
        F.col("l_linenumber") % 2 == 1,
        F.concat(F.col("l_linenumber").cast("string"), F.lit("Part "), F.col("l_partkey").cast("string")),
    ).otherwise(F.concat(F.lit("Item "), F.col("l_partkey").cast("string")))
    qty = F.when(bad, F.lit("1.2.3,4,5")).otherwise(S.format_amount("l_quantity"))
    line = F.concat(label, F.lit(" $ "), qty, F.lit(" $ "), S.format_amount("l_extendedprice"))
    line = F.when(F.col("l_linenumber") > 4, F.concat(F.lit("LATE LINES $ 0,00 $ 0,00\n"), line)).otherwise(line)
    return F.struct("o_orderpriority", "o_totalprice", "l_linenumber", "l_partkey", line.alias("t"))


def _outline_texts(lines, key):
    """Texts of the outline pages of sorted lines: one for each priority and total."""
    def same(a, b):
        return a["o_orderpriority"].eqNullSafe(b["o_orderpriority"]) & a["o_totalprice"].eqNullSafe(b["o_totalprice"])

    def text(head, body):
        total = S.format_amount(head["o_totalprice"] + F.lit(0))  # no negative zero
        return F.concat_ws("\n", F.concat(head["o_orderpriority"], F.lit(" $ "), total, F.lit(" $ "), total),
                           F.array_join(body, "\n"), F.concat(F.lit("Nota pedido "), key))

    ls = F.col(lines)
    first, last = F.get(ls, F.lit(0)), F.get(ls, F.size(ls) - 1)
    heads = F.array_distinct(F.transform(ls, lambda x: F.struct(x["o_orderpriority"].alias("o_orderpriority"),
                                                                x["o_totalprice"].alias("o_totalprice"))))
    several = F.transform(heads, lambda h: text(h, F.transform(F.filter(ls, lambda x: same(x, h)), lambda x: x["t"])))
    return F.when(same(first, last), F.array(text(first, ls["t"]))).otherwise(several)


def _positional_record(layout):
    """Record of a line in the positional layout, after what tells its place."""
    d = F.col("l_shipdate")
    ln = F.col("l_linenumber")
    if layout == 1:
        number = F.when((F.col("o_orderstatus") == "P") & (ln == 3), F.lit("x3")).otherwise(ln.cast("string"))
        lead = F.array(number)
    else:  # digit-led number + three skipped lines, or one non-digit line
        lead = F.when(ln % 2 == 1, F.array(ln.cast("string"), F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(
            F.array(F.lit("Nro"))
        )
    fields = F.array(
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")),
    )
    acct = F.when(
        F.col("l_returnflag") == "R",
        F.array(F.concat(F.lit("Cta "), F.col("l_suppkey").cast("string"), F.lit("-"), ln.cast("string"))),
    ).otherwise(F.array().cast("array<string>"))
    cont = F.when(F.col("l_linestatus") == "F", F.array(F.date_format(d, "dd-MM-yyyy"))).otherwise(
        F.array().cast("array<string>")
    )
    amounts = F.array(
        F.concat(F.lit("$"), S.format_amount("l_quantity")), F.concat(F.lit("$"), S.format_amount("l_extendedprice"))
    )
    rec = F.array_join(F.concat(lead, fields, acct, cont, amounts), "\n")
    return F.struct("l_linenumber", "l_partkey", "l_suppkey", rec.alias("t"))


# ----------------------------------------------------------------------------
# lines
# ----------------------------------------------------------------------------


@register(
    "txt_lines",
    """
    SELECT conv_id, turn, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
           unnest(string_split(text, chr(10))) AS line
    FROM conversations
    """,
)
def txt_lines(spark, sf):
    c = read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


_OUTLINE_ROWS_SQL = f"""
    SELECT l.l_orderkey AS page, o.o_orderstatus, l.l_linenumber,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS periodo,
           CASE WHEN l.l_linenumber > 4 THEN 'LATE LINES' ELSE o.o_orderpriority END AS concepto_principal,
           COALESCE(last_value(CASE WHEN l.l_linenumber % 2 = 1 THEN 'Part ' || CAST(l.l_partkey AS VARCHAR) END
                               IGNORE NULLS)
                    OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS concepto_secundario,
           CASE WHEN l.l_linenumber % 2 = 1 THEN 'Part ' ELSE 'Item ' END || CAST(l.l_partkey AS VARCHAR) AS item,
           CAST(l.l_quantity AS DECIMAL(18,2)) AS valor_101,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor_comunidad
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


@register(
    "txt_outline_expenses",
    f"""
    SELECT periodo, concepto_principal, concepto_secundario, item, valor_101, valor_comunidad
    FROM ({_OUTLINE_ROWS_SQL})
    WHERE NOT (o_orderstatus = 'P' AND l_linenumber = 2)
    """,
)
def txt_outline_expenses(spark, sf):
    return ST.outline_expenses(outline_pages(spark, sf))


@register(
    "txt_rejects",
    """
    SELECT l.l_orderkey AS page, 'unreadable amount' AS reject_reason
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus = 'P' AND l.l_linenumber = 2
    UNION ALL
    SELECT NULL, 'record number is not an integer'
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus = 'P' AND l.l_linenumber = 3
    """,
)
def txt_rejects(spark, sf):
    a = ST.outline_rejects(outline_pages(spark, sf)).select(
        F.col("page").cast("bigint").alias("page"), "reject_reason"
    )
    b = ST.positional_rejects(positional_pages(spark, sf)).select(
        F.lit(None).cast("bigint").alias("page"), "reject_reason"
    )
    return a.unionByName(b)


@register(
    "txt_amount_lines",
    """
    SELECT l.l_orderkey AS page,
           CASE WHEN l.l_linenumber % 2 = 1 THEN CAST(l.l_linenumber AS VARCHAR) || 'Part ' ELSE 'Item ' END
             || CAST(l.l_partkey AS VARCHAR) AS label
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    UNION ALL SELECT l_orderkey, 'LATE LINES' FROM lineitem WHERE l_linenumber > 4
    UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
    """,
)
def txt_amount_lines(spark, sf):
    lines = ST.page_lines(outline_pages(spark, sf))
    s = S.py_strip(F.col("line"))
    return lines.where(s.rlike(ST.AMOUNT_LINE)).select(
        "page", F.regexp_extract(s, ST.AMOUNT_LINE, 1).alias("label")
    )


@register(
    "date_period_from_name",
    f"""
    SELECT DISTINCT {_OUTLINE_PATH_SQL} AS path, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS periodo
    FROM orders o
    """,
)
def date_period_from_name(spark, sf):
    p = outline_pages(spark, sf).select("path").distinct()
    return p.select("path", D.period_from_name("path").alias("periodo"))


@register(
    "str_parse_amount",
    "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders",
)
def str_parse_amount(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", S.parse_amount(F.concat(F.lit("$"), S.format_amount("o_totalprice"))).alias("amount"))


# ----------------------------------------------------------------------------
# positional layouts
# ----------------------------------------------------------------------------

_POS_ITEM_SQL = (
    "'Part ' || CAST(l.l_partkey AS VARCHAR) || "
    "CASE WHEN l.l_linestatus = 'F' THEN ' ' || strftime(l.l_shipdate, '%d-%m-%Y') ELSE '' END"
)


@register(
    "txt_section_slice",
    f"""
    SELECT {_POS_PATH_SQL} AS path, CAST(5 AS BIGINT) AS start,
           CAST(5 + SUM(5 + CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END
                          + CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "end"
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderkey, o.o_orderdate
    """,
)
def txt_section_slice(spark, sf):
    b = ST.section_bounds(positional_pages(spark, sf))
    return b.select("path", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


@register(
    "txt_position_records",
    f"""
    SELECT DISTINCT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS periodo,
           'CONSUMOS BÁSICOS' AS concepto_principal,
           'Supplier ' || CAST(l.l_suppkey AS VARCHAR) AS concepto_secundario,
           {_POS_ITEM_SQL} AS item,
           CAST(l.l_quantity AS DECIMAL(18,2)) AS valor_101,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor_comunidad
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE NOT (o.o_orderstatus = 'P' AND l.l_linenumber = 3)
    """,
)
def txt_position_records(spark, sf):
    return ST.positional_expenses(positional_pages(spark, sf))


@register(
    "txt_position_accounts",
    """
    SELECT 'Supplier ' || CAST(l.l_suppkey AS VARCHAR) AS concepto_secundario,
           'Part ' || CAST(l.l_partkey AS VARCHAR) AS part,
           CASE WHEN l.l_returnflag = 'R'
                THEN 'Cta ' || CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) END AS cuenta
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE NOT (o.o_orderstatus = 'P' AND l.l_linenumber = 3)
    """,
)
def txt_position_accounts(spark, sf):
    p = ST.positional_parse(positional_pages(spark, sf)).where(F.col("reject_reason").isNull())
    return p.select("concepto_secundario", F.substring_index("item", " ", 2).alias("part"), "cuenta")


@register(
    "txt_position_records_layout2",
    f"""
    SELECT DISTINCT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS periodo,
           'CONSUMOS BÁSICOS' AS concepto_principal,
           'Supplier ' || CAST(l.l_suppkey AS VARCHAR) AS concepto_secundario,
           {_POS_ITEM_SQL} AS item,
           CAST(l.l_quantity AS DECIMAL(18,2)) AS valor_101,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor_comunidad
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
def txt_position_records_layout2(spark, sf):
    pages = positional_pages(spark, sf, layout=2)
    return ST.positional_expenses(pages, lead_lines=ST.layout2_lead_lines(), number_required=False)


@register(
    "str_starts_with_dollar",
    "SELECT CAST(2 * COUNT(*) AS BIGINT) AS n_lines FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
)
def str_starts_with_dollar(spark, sf):
    lines = ST.page_lines(positional_pages(spark, sf), space_before_dollar=False)
    return lines.where(S.starts_with_dollar("line")).agg(F.count(F.lit(1)).alias("n_lines"))


# ----------------------------------------------------------------------------
# report: union of three layouts, relabel, NOT IN, order
# ----------------------------------------------------------------------------

_RELABEL = {"Supplier 1": "Luz", "Supplier 2": "Agua"}


@register(
    "report_adjusted_expenses",
    f"""
    WITH e3 AS (
      SELECT DISTINCT periodo, concepto_principal,
             CASE WHEN concepto_secundario = 'Part 1' THEN 'Parte Uno' ELSE concepto_secundario END
               AS concepto_secundario,
             item, valor_101, valor_comunidad
      FROM ({_OUTLINE_ROWS_SQL})
      WHERE NOT (o_orderstatus = 'P' AND l_linenumber = 2) AND periodo >= DATE '1998-01-01'
        AND concepto_secundario <> item),
    pos AS (
      SELECT DISTINCT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS periodo,
             'CONSUMOS BÁSICOS' AS concepto_principal,
             'Supplier ' || CAST(l.l_suppkey AS VARCHAR) AS concepto_secundario,
             {_POS_ITEM_SQL} AS item,
             CAST(l.l_quantity AS DECIMAL(18,2)) AS valor_101,
             CAST(l.l_extendedprice AS DECIMAL(18,2)) AS valor_comunidad,
             NOT (o.o_orderstatus = 'P' AND l.l_linenumber = 3) AS first_layout
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
    -- the record number that the first layout can't read is no line of the second
    e2 AS (SELECT DISTINCT * EXCLUDE (first_layout) FROM pos WHERE first_layout AND periodo = DATE '1997-12-01'),
    e1 AS (
      SELECT periodo, concepto_principal,
             CASE WHEN concepto_secundario = 'Supplier 4' THEN 'Riego' ELSE concepto_secundario END AS concepto_secundario,
             CASE WHEN concepto_secundario = 'Supplier 4' THEN concepto_secundario ELSE item END AS item,
             valor_101, valor_comunidad
      FROM (SELECT DISTINCT * EXCLUDE (first_layout) FROM pos WHERE periodo < DATE '1997-12-01')
      WHERE concepto_secundario <> item),
    u AS (SELECT * FROM e3 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e1)
    SELECT periodo, concepto_principal,
           CASE WHEN concepto_secundario = 'Supplier 1' THEN 'Luz'
                WHEN concepto_secundario = 'Supplier 2' THEN 'Agua'
                ELSE concepto_secundario END AS concepto_secundario,
           item, valor_101, valor_comunidad
    FROM u
    WHERE concepto_secundario NOT IN ('Supplier 3')
    ORDER BY periodo DESC, concepto_secundario ASC, valor_comunidad DESC
    """,
)
def report_adjusted_expenses(spark, sf):
    named = F.col("concepto_secundario") != F.col("item")
    outline, first, second = statement_pages(spark, sf, outline=True, layouts=[1, 2])
    e3 = ST.outline_expenses(outline, min_period="1998-01-01", dedupe=True).where(named)
    e3 = SH.relabel(e3, "concepto_secundario", {"Part 1": "Parte Uno"})
    period, change = F.col("periodo"), F.lit("1997-12-01").cast("date")
    e2 = ST.positional_expenses(first, keep=period == change)
    e1 = ST.positional_expenses(second, keep=period < change,
                                lead_lines=ST.layout2_lead_lines(), number_required=False)
    e1 = ST.swap_label_item(e1.where(named), "Supplier 4", "Riego")
    return ST.adjusted_expenses([e3, e2, e1], _RELABEL, ["Supplier 3"])
