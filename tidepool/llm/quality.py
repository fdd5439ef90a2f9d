"""Quality rules: a threshold table compiled into one Spark projection.

A rule names a metric and the range it must lie in.  ``compile_rules`` turns
the whole table into one boolean expression over built-in functions: no user
function runs and no row is shuffled.

Defined results: a NULL text has no words (all counts 0); an empty text has
one empty line, which holds no word and so is never a duplicate; ratios of a
text without words are 0.  Repeated rows are judged alike, an empty table
gives an empty result, and other columns of the input are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six ASCII white-space characters and the counted symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on are as with they be at this from or by "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de et un une en du que dans est pour qui sur pas au par avec "
    "el los las y se por una con para al lo es del"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; ``None`` leaves that side open."""

    metric: str
    low: float | None = None
    high: float | None = None


#: Production thresholds.
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("symbols_per_word", high=0.1),
    Rule("shouts_per_word", high=0.5),
    Rule("upper_share", high=0.4),
    Rule("stop_words", low=2),
    Rule("stop_word_share", low=0.02),
    Rule("dup_line_share", high=0.4),
    Rule("ellipsis_line_share", high=0.3),
    Rule("bullet_line_share", high=0.9),
)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are sorted together with their positions; equal neighbours mark
    the repeats.  The covered words are the sum of min(3, gap to the next
    marked position): n log n for any text.  Texts without a repeat stop after
    one hash-set pass.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def marks(s: Column) -> Column:
            same = lambda x, j: x["w"].eqNullSafe(F.get(s, j)["w"])
            hit = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return F.sort_array(F.transform(hit, lambda x: x["i"]))

        def total(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        return _bind(_bind(placed, marks), total)

    def windows_of(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                           lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))

    def count(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(
            _bind(windows_of(w), lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0))
                  .otherwise(covered(t))))

    return count(words)


def _words(text: Column) -> Column:
    """Every white-space character becomes a blank, so one split finds the words."""
    return F.filter(F.split(F.translate(text, SPACES[1:], " " * 5), " "), lambda w: w != "")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)


def _metrics() -> dict[str, Column]:
    """Counts over the columns ``text, words, lines``; built-in expressions only."""
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    among = lambda marks: F.length(text) - F.length(F.translate(text, marks, ""))
    ended = lambda x: F.rtrim(F.translate(x, SPACES, " " * 6))
    begun = lambda x: F.ltrim(F.translate(x, SPACES, " " * 6))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": among(SYMBOLS),
        "n_shouts": among("!"),
        "n_upper": among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: ended(x).rlike(r"(\.\.\.|…)$"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: begun(x).rlike(r"^[-*•] "))),
    }
    return {n: c.cast("long") for n, c in counts.items()}


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


RATIOS = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: _share(F.col("word_chars"), F.col("n_words")),
    "symbols_per_word": lambda: _share(F.col("n_symbols"), F.col("n_words")),
    "shouts_per_word": lambda: _share(F.col("n_shouts"), F.col("n_words")),
    "upper_share": lambda: _share(F.col("n_upper"), F.col("word_chars")),
    "stop_words": lambda: F.col("n_stop_words"),
    "stop_word_share": lambda: _share(F.col("n_stop_words"), F.col("n_words")),
    "dup_line_share": lambda: _share(F.col("n_dup_lines"), F.col("n_lines")),
    "ellipsis_line_share": lambda: _share(F.col("n_ellipsis_lines"), F.col("n_lines")),
    "bullet_line_share": lambda: _share(F.col("n_bullet_lines"), F.col("n_lines")),
}


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean expression over the count columns."""
    verdict = F.lit(True)
    for r in rules:
        value = RATIOS[r.metric]()
        if r.low is not None:
            verdict = verdict & (value >= r.low)
        if r.high is not None:
            verdict = verdict & (value <= r.high)
    return verdict


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: id, counts, ``base_failed`` and ``kept``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = texts.select("doc_id", "text", _words(F.col("text")).alias("words"), _lines(F.col("text")).alias("lines"))
    counts = parts.select("doc_id", *[c.alias(n) for n, c in _metrics().items()])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_stop_words", "n_shouts", "n_upper",
        failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"),
    )
