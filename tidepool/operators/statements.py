"""Expense-statement text operators.

Input is a table of extracted page text ``(path, page, text)``; output are
expense rows ``(periodo, concepto_principal, concepto_secundario, item,
valor_101, valor_comunidad)`` plus reject rows that say why a line or record
could not be read.  Everything is a DataFrame expression: pages explode to
lines, windows carry headers forward, and records are cut by counting amount
lines.  No per-row Python, no driver loop, no early stop on a bad record.

Document order is ``(page, line_no)``: a page boundary is a line boundary.

Two statement layouts are supported:

* **outline** (one line per item): ``<label> $ <amount> $ <amount>``; an
  all-upper-case label is a category header, a digit-led label starts a
  sub-category (its own row is emitted too), other labels are items.
* **positional** (one field per line) inside the section that starts three
  lines after the marker line ``CONSUMOS BÁSICOS`` and ends at the first line
  that is a single blank: a leading line (record number), company,
  description, optional extra lines (account number, continuation text),
  then two ``$`` amount lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.dates import period_from_name
from tidepool.functions.strings import (
    is_upper,
    join_words,
    parse_amount,
    py_strip,
    starts_with_digit,
    starts_with_dollar,
    strip_leading_number,
)
from tidepool.operators.windows import running_sums_by_key
from tidepool.session import landed as write_and_read

# The amount-line pattern (label, blank(s), "$", amount, "$",
# amount), the section marker line and the section end line.
AMOUNT_LINE = r"(?U)^(.*?)\s+\$\s+([\d,.]+)\s+\$\s+([\d,.]+)$"
SECTION_MARKER = "CONSUMOS BÁSICOS"
SECTION_END = " "
# Continuation lines appended to a positional record's description: dates.
DATE_LINE = r"^\d{2}-\d{2}-\d{4}$"
#: Characters up to which a document is read in one row, and groups of documents whose sizes are added up first.
ROW_CHARS, SIZE_GROUPS = 1 << 20, 1 << 16

EXPENSE_COLUMNS = ["periodo", "concepto_principal", "concepto_secundario", "item", "valor_101", "valor_comunidad"]


def _once(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """``keep`` and new columns, each worked out once a row.  The optimizer moves filters below projections
    and repeats there what they read, once for each use; they don't pass a generator, here of one row."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def page_lines(pages: DataFrame, text: str = "text", space_before_dollar: bool = True) -> DataFrame:
    """``(path, page, text)`` -> ``(path, page, line_no, line)``, one row per
    ``\\n``-separated line (trailing empty lines kept, as ``str.split``).
    ``space_before_dollar`` inserts a blank before every ``$`` first."""
    t = F.col(text)
    if space_before_dollar:
        t = F.replace(t, F.lit("$"), F.lit(" $"))
    return pages.select("path", "page", F.posexplode(F.split(t, "\n", -1)).alias("line_no", "line"))


# --------------------------------------------------------------------------
# outline layout
# --------------------------------------------------------------------------


def _last_before(starts: str, size: Column, value=lambda p: p) -> Column:
    """For each place of an array of ``size``, ``value`` of the last of the places ``starts`` at or before it,
    -1 before the first: runs of equal values, put one after another."""
    runs = F.transform(starts, lambda p, k: F.array_repeat(value(p), F.coalesce(F.get(starts, k + 1), size) - p))
    return F.concat(F.array_repeat(F.lit(-1), F.coalesce(F.get(starts, F.lit(0)), size)), F.flatten(runs))


def _amount_lines(pages: DataFrame, key: Sequence[str], read: Column, reset_sub_on_category: bool) -> DataFrame:
    """``key`` and ``(line_no, header, digit, s, category, sub)`` of the amount lines of a page, from an array of
    (line_no, s) that has line feed, label, line feed, amount, line feed, amount of an amount line as ``s``;
    ``category`` and ``sub`` are the labels of those in force (NULL before the first).

    Everything happens inside the page's row, in as many steps as there are lines.
    """
    digit, header = 1, 2
    df = _once(pages, key, hits=F.filter(read, lambda x: x["s"].startswith("\n")))
    label = lambda x: F.substring(F.substring_index(x["s"], "\n", 2), F.lit(2), F.length(x["s"]))
    df = _once(df, [*key, "hits"], labels=F.transform("hits", label))
    kind = lambda x: F.when(is_upper(x), F.lit(header)).when(starts_with_digit(x), F.lit(digit)).otherwise(F.lit(0))
    df = _once(df, [*key, "hits", "labels"], kinds=F.transform("labels", kind))

    def places(test) -> Column:
        return F.filter(F.transform("kinds", lambda k, i: F.when(test(k), i)), lambda i: i.isNotNull())

    df = _once(df, [*key, "hits", "labels", "kinds"], headers=places(lambda k: k == header),
               subs=places(lambda k: (k == digit) | ((k == header) & F.lit(reset_sub_on_category))))
    size, sub = F.size("kinds"), lambda p: F.when(F.get("kinds", p) == digit, p).otherwise(F.lit(-1))
    df = _once(df, [*key, "hits", "labels", "kinds"], categories=_last_before("headers", size), subs=_last_before("subs", size, sub))
    rows = F.transform("hits", lambda x, i: F.struct(
        x["line_no"].alias("line_no"), (F.get("kinds", i) == header).alias("header"), (F.get("kinds", i) == digit).alias("digit"),
        x["s"].alias("s"), F.get("labels", F.get("categories", i)).alias("category"), F.get("labels", F.get("subs", i)).alias("sub")))
    return _once(df, key, rows=rows).select(*key, F.inline("rows"))


def outline_parse(pages: DataFrame, reset_sub_on_category: bool = False) -> DataFrame:
    """Every amount line of the outline layout, classified, with the category
    and sub-category in force; header lines and non-matching lines are
    dropped.  Adds ``reject_reason`` (NULL for good rows).

    ``pages`` are ``(path, page, text)`` rows, which no shuffle moves; lines of
    :func:`page_lines` are taken too and put together by page first.
    Category and sub-category start empty on every page.  As in the source
    statements' reading, a new category does *not* reset the sub-category
    unless ``reset_sub_on_category``.  A NULL text has no line.
    """
    def read(line_no: Column, line: Column) -> Column:
        # one match per line; what matched begins with a line feed, as no stripped line does
        parts = F.when(line.contains("$"), F.regexp_replace(py_strip(line), AMOUNT_LINE, "\n$1\n$2\n$3"))
        return F.struct(line_no.alias("line_no"), parts.alias("s"))

    if "line" in pages.columns:
        pages = pages.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_ls"))
        lines = F.transform("_ls", lambda x: read(x["line_no"], x["line"]))
    else:
        lines = F.transform(F.split(F.replace(F.col("text"), F.lit("$"), F.lit(" $")), "\n", -1), lambda x, i: read(i, x))
    key = ["path", "page", "periodo"]
    df = _amount_lines(pages.withColumn("periodo", period_from_name(F.col("path"))), key, lines, reset_sub_on_category)
    df = df.where(~F.col("header"))
    df = _once(df, [*key, "line_no", "digit", "category", "sub"], p=F.split("s", "\n", -1))
    label, sub = F.col("p")[1], strip_leading_number("sub")
    df = _once(df, [*key, "line_no"],
               concepto_principal=F.coalesce("category", F.lit("")), concepto_secundario=F.coalesce(sub, F.lit("")),
               item=F.when(F.col("digit"), strip_leading_number(label)).otherwise(label),
               valor_101=parse_amount(F.col("p")[2]), valor_comunidad=parse_amount(F.col("p")[3]))
    reason = (
        F.when(F.col("periodo").isNull(), F.lit("no period in file name"))
        .when(F.col("valor_101").isNull() | F.col("valor_comunidad").isNull(), F.lit("unreadable amount"))
    )
    return df.select("path", "page", "line_no", "periodo", "concepto_principal", "concepto_secundario", "item",
                     "valor_101", "valor_comunidad", reason.alias("reject_reason"))


def pages_of(pages: DataFrame, keep: Column | None) -> DataFrame:
    """Pages whose period (``periodo``, read from the path) passes ``keep``, so that
    no other page is split or parsed."""
    if keep is None:
        return pages
    return pages.withColumn("periodo", period_from_name(F.col("path"))).where(keep).drop("periodo")


def outline_expenses(pages: DataFrame, min_period: str | None = None, reset_sub_on_category: bool = False,
                     dedupe: bool = False) -> DataFrame:
    """Expense rows of the outline layout (optionally only periods >=
    ``min_period``, optionally without duplicates)."""
    keep = F.col("periodo") >= F.lit(min_period).cast("date") if min_period else None
    p = outline_parse(pages_of(pages, keep), reset_sub_on_category).where(F.col("reject_reason").isNull()).select(*EXPENSE_COLUMNS)
    return p.dropDuplicates() if dedupe else p


def outline_rejects(pages: DataFrame) -> DataFrame:
    return outline_parse(pages).where(F.col("reject_reason").isNotNull())


# --------------------------------------------------------------------------
# positional layout
# --------------------------------------------------------------------------


def _whole_pages(pages: DataFrame) -> DataFrame:
    """``(path, page, text)``, put together from lines of :func:`page_lines` if those are given."""
    if "line" not in pages.columns:
        return pages
    placed = pages.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_ls"))
    return placed.select("path", "page", F.array_join(F.transform("_ls", lambda x: x["line"]), "\n").alias("text"))


def _by_size(pages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pages of the documents of at most ``ROW_CHARS`` characters, and those of the others
    (None if there are none).  Sizes are added up by groups of documents first, so that only
    groups above that size are counted document by document."""
    spark = pages.sparkSession
    pages = pages.where("path IS NOT NULL")  # lines without a path have no document
    chars, group = F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).alias("chars"), F.pmod(F.xxhash64("path"), F.lit(SIZE_GROUPS))
    large = pages.groupBy(group.alias("g")).agg(chars).where(F.col("chars") > ROW_CHARS).select("g")
    large = write_and_read(spark, large, "statement_large")
    if large.isEmpty():
        return pages, None
    some = pages.withColumn("g", group).join(F.broadcast(large), "g", "left_semi")
    long = write_and_read(spark, some.groupBy("path").agg(chars).where(F.col("chars") > ROW_CHARS).select("path"), "statement_long")
    if long.isEmpty():
        return pages, None
    return pages.join(long, "path", "left_anti"), pages.join(long, "path", "left_semi")


def _row_sections(pages: DataFrame, marker: str, end_line: str) -> DataFrame:
    """``(path, start, end, inside)`` of documents that fit a row: the section's bounds as in
    :func:`_sections` and the lines from the marker to the end, each with its line feed."""
    place = F.struct("page", F.monotonically_increasing_id().alias("row"), "text")
    docs = pages.select("path", place.alias("p")).groupBy("path").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    mark, stop = f"\n{marker}\n", f"\n{end_line}\n"
    docs = _once(docs, ["path"], t=F.concat(F.lit("\n"), F.array_join("ps.text", "\n"), F.lit("\n")))
    docs = _once(docs, ["path", "t"], first=F.locate(mark, F.col("t"))).where("first > 0")
    # the line feed that ends the marker line may begin the end line
    at = F.call_function("locate", F.lit(stop), F.col("t"), F.col("first") + len(mark) - 1)
    docs = _once(docs, ["path", "t"], at=at).where("at > 0")
    docs = _once(docs, ["path"], head=F.substring("t", F.lit(1), F.col("at")))
    docs = _once(docs, ["path", "head"], inside=F.substring_index("head", mark, -1))

    def line_feeds(c: str) -> Column:
        return F.length(c) - F.length(F.replace(F.col(c), F.lit("\n"), F.lit("")))

    docs = _once(docs, ["path", "inside"], of_head=line_feeds("head"), of_inside=line_feeds("inside"))
    return docs.select("path", (F.col("of_head") + 2 - F.col("of_inside")).cast("bigint").alias("start"),
                       F.col("of_head").cast("bigint").alias("end"), "inside")


def _row_records(sections: DataFrame) -> DataFrame:
    """``(path, periodo, record, _lines, n_dollar)`` as in :func:`_records`."""
    # the two lines after the marker and what follows the last line feed are no lines of the section
    lines = F.split("inside", "\n", -1)
    s = _once(sections.where("end > start"), ["path"], periodo=period_from_name(F.col("path")),
              lines=F.slice(lines, F.lit(3), (F.col("end") - F.col("start")).cast("int")))
    s = _once(s, ["path", "periodo", "lines"], dollars=F.filter(F.transform(
        "lines", lambda x, i: F.when(x.contains("$") & starts_with_dollar(x), i)), lambda i: i.isNotNull()))
    cuts = F.transform(F.filter("dollars", lambda i, j: j % 2 == 1), lambda i: i + 1)
    s = _once(s, ["path", "periodo", "lines", "dollars"], cuts=F.concat(F.array(F.lit(0)), cuts, F.array(F.size("lines"))))
    pieces = F.transform(F.slice("cuts", F.lit(1), F.size("cuts") - 1), lambda a, k: F.struct(
        k.cast("bigint").alias("record"), F.slice("lines", a + 1, F.get("cuts", k + 1) - a).alias("_lines"),
        F.least(F.lit(2), F.size("dollars") - 2 * k).cast("bigint").alias("n_dollar")))
    return s.select("path", "periodo", F.inline(pieces)).where(F.size("_lines") > 0)


def _document_records(pages: DataFrame, marker: str, end_line: str) -> DataFrame:
    """Records of all documents: of those that fit a row within it, of longer ones page by page."""
    short, long = _by_size(_whole_pages(pages))
    recs = _row_records(_row_sections(short, marker, end_line))
    return recs if long is None else recs.unionByName(_records(_landed_pages(long, marker, end_line)))


def _landed_pages(pages: DataFrame, marker: str, end_line: str, text: str = "text",
                  space_before_dollar: bool = False) -> DataFrame:
    """``(row, path, periodo, page, lines, n, marks, ends, dollars)``, landed in the
    shared scratch folder: each page split once, with the 0-based places of
    its marker, end and ``$`` lines.  ``row`` tells repeated pages apart; as
    the table is written, all later scans see the same rows.

    ``pages`` are ``(path, page, text)`` or lines of :func:`page_lines`, which
    are put together by page again.  A NULL text has no line.
    """
    if "line" in pages.columns:
        placed = pages.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_ls"))
        split = placed.select("path", "page", F.transform("_ls", lambda x: x["line"]).alias("lines"))
    else:
        t = F.coalesce(F.col(text), F.lit(""))
        if space_before_dollar:
            t = F.replace(t, F.lit("$"), F.lit(" $"))
        none = F.array().cast("array<string>")
        split = pages.select("path", "page", F.when(F.col(text).isNull(), none)
                             .otherwise(F.split(t, "\n", -1)).alias("lines"))

    def places(test) -> Column:
        return F.filter(F.transform("lines", lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())

    out = split.select(
        F.monotonically_increasing_id().alias("row"), "path", period_from_name(F.col("path")).alias("periodo"), "page",
        "lines", F.size("lines").alias("n"),
        places(lambda x: x == marker).alias("marks"),
        places(lambda x: x == end_line).alias("ends"),
        places(lambda x: x.contains("$") & starts_with_dollar(x)).alias("dollars"),
    )
    return write_and_read(pages.sparkSession, out, "statement_pages")


def _with_offsets(landed: DataFrame, *columns: str) -> DataFrame:
    """Narrow page rows with the lines and ``$`` lines of the document before each page
    (``off``, ``dollars_before``)."""
    narrow = landed.select("row", "path", "page", "n", F.size("dollars").alias("nd"), *columns)
    return running_sums_by_key(narrow, "path", ["page", "row"], {"off": F.col("n"), "dollars_before": F.col("nd")}).drop("nd")


def _sections(landed: DataFrame) -> DataFrame:
    """One narrow row per page: its line offset in the document (``off``) and
    the document's section (``start``, ``end``; 1-based, end exclusive).

    ``end`` is the first end line after the first marker; ``start`` is three
    lines after the last marker before ``end``; both NULL without such a pair.
    No text is moved, only counts and places, and a document is cut at any page.
    """
    s = _with_offsets(landed, "periodo", "marks", "ends", "dollars")
    for c in ("marks", "ends"):
        s = s.withColumn(c, F.transform(c, lambda i: i + F.col("off") + 1))
    s = write_and_read(landed.sparkSession, s, "statement_places")
    # each bound is a least or greatest place, so that runs of pages are added up before they meet
    first = s.groupBy("path").agg(F.min(F.array_min("marks")).alias("first")).where("first IS NOT NULL")
    ends = s.where(F.size("ends") > 0).select("path", "ends").join(first, "path")
    end = ends.groupBy("path").agg(F.min(F.array_min(F.filter("ends", lambda e: e > F.col("first")))).alias("end"))
    marks = s.where(F.size("marks") > 0).select("path", "marks").join(end.where(F.col("end").isNotNull()), "path")
    bounds = marks.groupBy("path", "end").agg((F.max(F.array_max(F.filter("marks", lambda m: m < F.col("end")))) + 3).alias("start"))
    early = s.select("path", "off", "dollars").join(bounds, "path").select(
        "path", "end", "start", F.size(F.filter("dollars", lambda i: i + F.col("off") + 1 < F.col("start"))).alias("early"))
    bounds = early.groupBy("path", "end", "start").agg(F.sum("early").alias("before_start"))
    return s.join(bounds, "path", "left")


def numbered_lines(pages: DataFrame, text: str = "text", space_before_dollar: bool = False) -> DataFrame:
    """``(path, page, text)`` -> ``(path, page, line_no, line, gidx)`` where
    ``gidx`` is the 1-based line position in the whole document.

    Numbered from the pages, not the lines: a running sum of the line counts
    over one narrow row per page gives each page's offset.  Pages that repeat
    a (path, page) follow one another.
    """
    landed = _landed_pages(pages, SECTION_MARKER, SECTION_END, text, space_before_dollar)
    off = _with_offsets(landed).select("row", "off")
    return landed.select("row", "path", "page", "lines").join(off, "row").select(
        "path", "page", "off", F.posexplode("lines").alias("line_no", "line")
    ).select("path", "page", "line_no", "line", (F.col("off") + F.col("line_no") + 1).alias("gidx"))


def section_bounds(pages: DataFrame, marker: str = SECTION_MARKER, end_line: str = SECTION_END) -> DataFrame:
    """Per document ``(path, start, end)``, as in :func:`positional_parse`;
    documents without both lines are absent."""
    short, long = _by_size(_whole_pages(pages))
    bounds = _row_sections(short, marker, end_line).select("path", "start", "end")
    if long is None:
        return bounds
    s = _sections(_landed_pages(long, marker, end_line))
    return bounds.unionByName(s.where(F.col("start").isNotNull()).select("path", "start", "end").distinct())


def _records(landed: DataFrame) -> DataFrame:
    """``(path, periodo, record, _lines, n_dollar)``: the section's lines, cut after
    every second ``$`` line.

    The cuts are found on the narrow page rows; each page is then sliced where
    its lines are, and the slices of a record meet by (path, record).  A hot
    document is spread over its records.
    """
    s = _sections(landed).where(F.col("start").isNotNull())
    lo = F.greatest(F.lit(0), F.col("start") - F.col("off") - 1)
    hi = F.least(F.col("n"), F.col("end") - F.col("off") - 1)
    s = s.withColumn("lo", lo).withColumn("hi", hi)
    s = s.withColumn("skipped", F.size(F.filter("dollars", lambda i: i < F.col("lo"))))
    s = s.withColumn("dollars", F.filter("dollars", lambda i: (i >= F.col("lo")) & (i < F.col("hi"))))
    # $ lines of the section before the page: those of the document, less those before the section
    s = s.withColumn("nd", F.col("dollars_before") + F.col("skipped") - F.col("before_start"))
    # landed, so that the counts and places are worked out once and not for every cut
    s = write_and_read(landed.sparkSession, s.drop("marks", "ends"), "statement_section")
    second = F.filter("dollars", lambda i, j: (F.col("nd") + j) % 2 == 1)
    cuts = F.transform(second, lambda i: (i + 1).cast("bigint"))
    s = s.where("hi > lo").withColumn("cuts", F.concat(F.array("lo"), cuts, F.array("hi")))
    piece = F.transform(
        F.slice("cuts", F.lit(1), F.size("cuts") - 1),
        lambda x, k: F.struct((F.floor(F.col("nd") / 2) + k).cast("bigint").alias("record"), x.alias("a"),
                              F.get("cuts", k + 1).alias("b")),
    )
    s = s.select("row", "path", "periodo", "page", "dollars", F.filter(piece, lambda p: p["b"] > p["a"]).alias("pieces"))
    cut = landed.select("row", "lines").join(s, "row").select(
        "path", "periodo", "page", "row", "lines", "dollars", F.explode("pieces").alias("p"))
    inside = F.filter("dollars", lambda i: (i >= F.col("p.a")) & (i < F.col("p.b")))
    cut = cut.select(
        "path", "periodo", "page", "row", F.col("p.record").alias("record"), F.size(inside).alias("_d"),
        F.slice("lines", (F.col("p.a") + 1).cast("int"), (F.col("p.b") - F.col("p.a")).cast("int")).alias("_ls"))
    whole = F.array_sort(F.collect_list(F.struct("page", "row", "_ls")))
    return cut.groupBy("path", "periodo", "record").agg(
        F.flatten(F.transform(whole, lambda x: x["_ls"])).alias("_lines"), F.sum("_d").alias("n_dollar"))


def positional_parse(
    pages: DataFrame,
    lead_lines: Column | int = 1,
    number_required: bool = True,
    continuation_values: Sequence[str] = (),
    continuation_pattern: str | None = DATE_LINE,
    marker: str = SECTION_MARKER,
) -> DataFrame:
    """Records of the positional layout, one row per record, with
    ``reject_reason`` (NULL for good records).

    ``pages`` are ``(path, page, text)`` rows; lines of :func:`page_lines`
    are taken too and put together by page first.

    A record ends at its second ``$`` line.  Its first ``lead_lines`` lines
    are skipped (the record number; a Column may depend on ``_first`` = the
    record's first line, e.g. four lines when it is digit-led), then come the
    company and the description; the lines between description and amounts
    are the account (the last of them that is not a continuation line) and
    continuation lines, which are appended to the description.
    ``number_required``: the first line must be an integer.
    A record may have any number of lines: all of them go into its one row.
    """
    recs = _document_records(pages, marker, SECTION_END)
    skip = lead_lines if isinstance(lead_lines, Column) else F.lit(lead_lines)
    n = F.col("n")
    recs = recs.withColumn("n", F.size("_lines")).withColumn("_first", F.get(F.col("_lines"), 0))
    a1, a2 = F.get(F.col("_lines"), n - 2), F.get(F.col("_lines"), n - 1)
    recs = _once(recs, recs.columns, _skip=skip, valor_101=parse_amount(a1), valor_comunidad=parse_amount(a2))
    number_ok = F.col("_first").try_cast("int").isNotNull() if number_required else F.lit(True)
    reason = (
        F.when(F.col("n_dollar") < 2, F.lit("incomplete record"))
        .when(n < F.col("_skip") + 4, F.lit("record too short"))
        .when(~number_ok, F.lit("record number is not an integer"))
        .when(F.col("periodo").isNull(), F.lit("no period in file name"))
        .when(F.col("valor_101").isNull() | F.col("valor_comunidad").isNull(), F.lit("unreadable amount"))
    )
    key = ["path", "record", "periodo", "valor_101", "valor_comunidad", "reject_reason"]
    # a filter on the reason comes before the rest is read
    recs = recs.withColumn("reject_reason", reason)
    middle = F.slice(F.col("_lines"), F.col("_skip") + 3, F.greatest(n - F.col("_skip") - 4, F.lit(0)))
    recs = _once(recs, [*key, "_lines", "_skip"], _middle=middle)
    cont_vals = F.array(*[F.lit(v) for v in continuation_values]) if continuation_values else None

    def is_cont(x: Column) -> Column:
        c = F.lit(False)
        if cont_vals is not None:
            c = c | F.array_contains(cont_vals, x)
        if continuation_pattern:
            c = c | x.rlike(continuation_pattern)
        return c

    # the account is the last middle line that is not a continuation line;
    # every other middle line continues the description
    acct_idx = F.col("_acct")
    recs = _once(recs, [*key, "_lines", "_skip", "_middle"],
                 _acct=F.array_max(F.transform("_middle", lambda x, i: F.when(~is_cont(x), i))))
    extra = F.filter("_middle", lambda x, i: acct_idx.isNull() | (i != acct_idx))
    description = F.get(F.col("_lines"), F.col("_skip") + 1)
    recs = _once(recs, key, concepto_secundario=F.get(F.col("_lines"), F.col("_skip")),
                 item=F.array_join(F.concat(F.array(description), extra), " "), cuenta=F.get(F.col("_middle"), acct_idx))
    return recs.select("path", "record", "periodo", F.lit(marker).alias("concepto_principal"), "concepto_secundario", "item",
                       "cuenta", "valor_101", "valor_comunidad", "reject_reason")


def positional_expenses(pages: DataFrame, dedupe: bool = True, keep: Column | None = None, **kw) -> DataFrame:
    """Good positional records as expense rows (duplicates dropped, as the
    statements list a charge once per period), of the periods that pass ``keep``."""
    p = positional_parse(pages_of(pages, keep), **kw).where(F.col("reject_reason").isNull()).select(*EXPENSE_COLUMNS)
    return p.dropDuplicates() if dedupe else p


def positional_rejects(pages: DataFrame, **kw) -> DataFrame:
    return positional_parse(pages, **kw).where(F.col("reject_reason").isNotNull())


def layout2_lead_lines() -> Column:
    """Second layout: a digit-led first line is followed by three lines that
    are skipped too; otherwise only the first line is skipped."""
    return F.when(starts_with_digit(F.col("_first")), F.lit(4)).otherwise(F.lit(1))


def swap_label_item(expenses: DataFrame, label: str, new_label: str) -> DataFrame:
    """Rows filed under ``label`` that names the item: the item takes the label
    and the label becomes ``new_label``; all others stay."""
    hit = F.col("concepto_secundario").eqNullSafe(F.lit(label))
    return expenses.withColumns({
        "concepto_secundario": F.when(hit, F.lit(new_label)).otherwise(F.col("concepto_secundario")),
        "item": F.when(hit, F.col("concepto_secundario")).otherwise(F.col("item")),
    })


# --------------------------------------------------------------------------
# report
# --------------------------------------------------------------------------


def adjusted_expenses(
    parts: Sequence[DataFrame], relabel: dict[str, str], exclude: Sequence[str]
) -> DataFrame:
    """Union of expense tables (by name), drop excluded labels (``NOT IN``:
    NULL labels drop too), relabel ``concepto_secundario``, and order by
    period desc, label asc, community amount desc."""
    from tidepool.operators.shape import not_in, relabel_expr

    u = parts[0].select(*EXPENSE_COLUMNS)
    for p in parts[1:]:
        u = u.unionByName(p.select(*EXPENSE_COLUMNS))
    # as in SQL, WHERE sees the input column, the relabel is the output
    u = u.where(not_in("concepto_secundario", exclude))
    u = u.withColumn("concepto_secundario", relabel_expr("concepto_secundario", relabel))
    return u.orderBy(F.col("periodo").desc(), F.col("concepto_secundario").asc(), F.col("valor_comunidad").desc())


__all__ = [
    "page_lines", "outline_parse", "outline_expenses", "outline_rejects", "section_bounds",
    "positional_parse", "positional_expenses", "positional_rejects", "layout2_lead_lines", "swap_label_item",
    "adjusted_expenses",
    "join_words",
]
