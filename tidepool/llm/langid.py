"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces of
the product of their probabilities, which a forward algorithm adds up from
left to right.  A text scores the sum of its words' log probabilities; the
score of a prediction is the posterior under equal priors.

The piece probabilities are fitted by expectation maximisation on a bounded
sample of labelled rows (``sample_rows`` per language, picked by a hash of the
id and the text), or on all of them.  The model has one row per piece and language: the vocabulary and
``max_languages`` bound what is collected and broadcast.

Words are runs of letters (Unicode category L) in lower case, opened by the
vocabulary's word mark.  Sums of long words are lifted as they go, so that a
word of any length is summed over all its segmentations; a very long text is
one row, at most Spark's 2 GiB.

Defined results: a NULL text, or one without letters, is ``und`` with score 0,
as is every text if no labelled row exists.  Of more than ``max_languages`` labels
those with the most rows are learnt.  Ties go to the language that comes first
by code point.  Rows with a NULL label train nothing; repeated rows count
repeatedly; an empty table gives no rows.  Other columns are passed through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import landed, release_memory, ship_package, small_batches
from tidepool.operators.windows import running_sums_by_key

UNKNOWN = "und"
MARK = "▁"
#: Runs of letters in the sense of Unicode's general category L.
LETTERS = regex.compile(r"\p{L}+")
#: Labelled rows per language that the fit reads, rounds of the fit, most languages.
SAMPLE_ROWS = 400
#: The share of a language's labelled rows that may lie below its least likelihood, and how much further than that
#: share's quantile it lies from the median.
FLOOR_SHARE, FLOOR_REACH = 0.001, 1.25
ROUNDS = 3
MAX_LANGUAGES = 200
#: Probability of a letter outside the vocabulary.
OUTSIDE = 1e-7
#: A forward or backward sum below the first is lifted by a power of ten, which is kept as a logarithm.
TINY, LIFT = 1e-100, 1e100
#: Letters of words that are summed at once.
LETTERS_AT_ONCE = 150_000
#: Tokens whose scores a task remembers.
MEMORY = 250_000


def vocabulary(path: str) -> list[str]:
    """Letter pieces of a sentencepiece model file, lower-cased, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == MARK or LETTERS.fullmatch(p.removeprefix(MARK)) is not None)


def word_parts(token: str) -> list[str]:
    """Marked words of a token."""
    return [MARK + run for run in LETTERS.findall(token.lower())]


class Lattice:
    """Forward and backward sums over all segmentations of many words at once."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        # one row per piece, then one for letters outside the vocabulary, then one for "no piece"
        n = prob.shape[1]
        self.prob = np.vstack([prob, np.full((1, n), OUTSIDE), np.zeros((1, n))])
        self.outside, self.none = len(pieces), len(pieces) + 1
        self.by_length = {}
        for size in sorted({len(p) for p in pieces}):
            own = [i for i, p in enumerate(pieces) if len(p) == size]
            keys = self._keys(np.array([pieces[i] for i in own], dtype=f"<U{size}"), size)
            order = np.argsort(keys)
            self.by_length[size] = (keys[order], np.array(own)[order])

    @staticmethod
    def _chars(words: np.ndarray, size: int) -> np.ndarray:
        return words.astype(f"<U{size}").view(np.uint32).reshape(len(words), size).astype(np.uint64)

    def _keys(self, words: np.ndarray, size: int) -> np.ndarray:
        chars, key = self._chars(words, size), np.full(len(words), size, dtype=np.uint64)
        for k in range(size):
            key = key * np.uint64(0x9E3779B97F4A7C15) + chars[:, k]
        return key

    def _pieces(self, words: np.ndarray, size: int) -> dict[int, np.ndarray]:
        """Piece numbers of all substrings: length -> (word, start)."""
        chars, found = self._chars(words, size), {}
        for n, (keys, number) in self.by_length.items():
            if n > size:
                break
            key = np.full((len(words), size - n + 1), n, dtype=np.uint64)
            for k in range(n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + chars[:, k:size - n + 1 + k]
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found[n] = np.where(keys[spot] == key, number[spot], self.none)
        one = found.get(1, np.full((len(words), size), self.none))
        found[1] = np.where(one == self.none, self.outside, one)
        return found

    def _sums(self, found: dict[int, np.ndarray], m: int, size: int, backward: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Forward sums at every end (or backward sums at every begin) of ``m`` words, and
        the logarithms by which each was lifted.  The sums of the longest piece's reach
        are always lifted alike, so they can be added up."""
        sums, lifted = np.zeros((2, size + 1, m, self.prob.shape[1]))
        reach = max(found)
        sums[size if backward else 0] = 1.0
        for k in range(1, size + 1):
            at = size - k if backward else k
            for n, number in found.items():
                if n <= k:
                    sums[at] += (sums[at + n] * self.prob[number[:, at]] if backward
                                 else sums[at - n] * self.prob[number[:, at - n]])
            lifted[at] = lifted[at + 1 if backward else at - 1]
            low = (sums[at] < TINY) & (sums[at] > 0)
            if low.any():
                near = slice(at, min(size, at + reach) + 1) if backward else slice(max(0, at - reach), at + 1)
                sums[near] *= np.where(low, LIFT, 1.0)
                lifted[near] = np.where(low, lifted[at] + np.log(LIFT), lifted[near])
        return sums, lifted

    def _groups(self, words: list[str]):
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        every = np.array(words, dtype=object)
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            step = max(1, min(8_192, LETTERS_AT_ONCE // size))
            for lo in range(0, len(at), step):
                yield size, at[lo:lo + step], every[at[lo:lo + step]].astype(f"<U{size}")

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), self.prob.shape[1]))
        for size, at, some in self._groups(words):
            sums, lifted = self._sums(self._pieces(some, size), len(some), size)
            out[at] = np.log(sums[size]) - lifted[size]
        return out

    def expected(self, words: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece per language, by forward and
        backward sums; ``weight`` has the words' counts per language."""
        uses = np.zeros_like(self.prob)
        for size, at, some in self._groups(words):
            found = self._pieces(some, size)
            (alpha, up), (beta, down) = self._sums(found, len(some), size), self._sums(found, len(some), size, backward=True)
            share, plain = weight[at] / alpha[size], not (up.any() or down.any())
            for begin in range(size):
                for n, number in found.items():
                    if begin + n <= size:
                        use = alpha[begin] * self.prob[number[:, begin]] * beta[begin + n]
                        if not plain:  # the three may be far apart, their product isn't
                            with np.errstate(divide="ignore"):
                                use = np.exp(np.log(alpha[begin]) + np.log(self.prob[number[:, begin]]) + np.log(beta[begin + n])
                                             - up[begin] - down[begin + n] + up[size])
                        np.add.at(uses, number[:, begin], use * share)
        return uses[:self.outside]


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    prob: np.ndarray  # piece x language


def labelled(docs: DataFrame, training: Column | None, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``id, text, lang`` of the rows that may teach."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       (F.lit(True) if training is None else training).alias("training"))
    return rows.where(F.col("training") & F.col("lang").isNotNull() & F.col("text").isNotNull()).drop("training")


def drawn(rows: DataFrame, sizes: dict[str, int], per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language in ``sizes``, by a hash of id and text."""
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.col("text"), F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(draw < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(0.0)))


def quantiles(spark: SparkSession, rows: DataFrame, key: str, value: str, shares: list[float]) -> dict[str, list[float]]:
    """For each key the exact quantiles of ``value`` at ``shares``, interpolated as ``percentile``
    does.  Equal values are counted first and ranked by a skew-safe running sum, so no task
    holds the values of a key; the driver gets two values per share and key."""
    counts = landed(spark, rows.groupBy(key, value).agg(F.count("*").alias("n")), "langid-values")
    totals = {r[0]: r["n"] for r in counts.groupBy(key).agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    ranks = {k: sorted({int(x) for s in shares for x in (np.floor(s * (n - 1)), np.ceil(s * (n - 1)))}) for k, n in totals.items()}
    asked = F.create_map(*[x for k, at in ranks.items() for x in (F.lit(k), F.array(*[F.lit(r).cast("long") for r in at]))])
    placed = running_sums_by_key(counts, key, [value], {"before": F.col("n")})
    met = F.filter(F.try_element_at(asked, F.col(key)), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    at = {(r[0], k): r[1] for r in placed.select(key, value, met.alias("met")).where(F.size("met") > 0).collect() for k in r["met"]}

    def quantile(k: str, place: float) -> float:
        low, high = at[k, int(np.floor(place))], at[k, int(np.ceil(place))]
        return low if low == high else low + (high - low) * (place - np.floor(place))

    return {k: [quantile(k, s * (n - 1)) for s in shares] for k, n in totals.items()}


def least_likelihoods(spark: SparkSession, scored: DataFrame, model: LanguageModel, lang_col: str = "lang",
                      prediction: str = "p") -> dict[str, float]:
    """For each language the mean log probability per letter below which a text is not
    taken for that language, from all of its labelled rows.  ``scored`` are rows with
    their label and the struct of :func:`predict`."""
    if not model.languages:
        return {}
    seen = scored.select(F.col(lang_col).alias("lang"), F.col(f"{prediction}.per_letter").alias("per_letter"))
    seen = seen.where(F.col("lang").isin(model.languages) & F.col("per_letter").isNotNull())
    return {k: q[1] + FLOOR_REACH * (q[0] - q[1]) for k, q in quantiles(spark, seen, "lang", "per_letter", [FLOOR_SHARE, 0.5]).items()}


def fit(spark: SparkSession, docs: DataFrame, vocabulary_path: str, training: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int | None = SAMPLE_ROWS, rounds: int = ROUNDS, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit on the labelled rows for which ``training`` holds, on all of them if ``sample_rows`` is None."""
    ship_package(spark)
    pieces = vocabulary(vocabulary_path)
    rows = labelled(docs, training, id_col, text_col, lang_col)
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["n"] for r in most.collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)))
    learnt = rows.where(F.col("lang").isin(languages)) if sample_rows is None else drawn(rows, sizes, sample_rows)

    def split(batches):
        for pdf in batches:  # words are counted per batch, so that each leaves it once
            counts = {}
            for lang, texts in pdf.groupby("lang")["text"]:
                tokens = Counter()
                for text in texts:
                    tokens.update(text.split())
                for token, n in tokens.items():
                    for word in word_parts(token):
                        counts[lang, word] = counts.get((lang, word), 0) + n
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"])
            del pdf, counts
        release_memory()

    words = (learnt.select("lang", "text").mapInPandas(split, "lang string, word string, n long")
             .groupBy("word", "lang").agg(F.sum("n").alias("n"))
             .groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")))
    counts = [F.coalesce(F.col("by_lang")[k], F.lit(0)).cast("double") for k in languages]
    with small_batches(spark):
        words = landed(spark, words.select("word", F.array(*counts).alias("n")), "langid-words")
    prob = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((pieces, prob))

        def expect(batches):
            lattice, uses = Lattice(*model.value), 0.0
            for pdf in batches:
                if len(pdf):
                    uses = uses + lattice.expected(pdf["word"].tolist(), np.vstack(pdf["n"].to_numpy()))
            if np.ndim(uses):
                used = np.flatnonzero(uses.any(axis=1))
                yield pd.DataFrame({"piece": used, "uses": list(uses[used])})
            del lattice
            release_memory()

        sums = [F.sum(F.col("uses")[k]) for k in range(len(languages))]
        uses = np.full_like(prob, 0.01)  # a trace for pieces the sample does not hold
        for r in words.mapInPandas(expect, "piece long, uses array<double>").groupBy("piece").agg(*sums).collect():
            uses[r[0]] += r[1:]
        prob = uses / uses.sum(axis=0)
    return LanguageModel(languages, pieces, prob)


class Scorer:
    """Predictions for batches of texts; remembers the scores of tokens."""

    def __init__(self, model: LanguageModel):
        self.languages = model.languages
        self.lattice = Lattice(model.pieces, model.prob)
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.score = np.zeros((0, len(self.languages)))
        self.letters = np.zeros(0, dtype=np.int64)

    def _learn(self, tokens: list[str]) -> np.ndarray:
        parts = [word_parts(t) for t in tokens]
        words = list(dict.fromkeys(p for ps in parts for p in ps))
        place = {w: i for i, w in enumerate(words)}
        logs = self.lattice.log_prob(words)
        out = np.zeros((len(tokens), len(self.languages)))
        owner = np.repeat(np.arange(len(tokens)), [len(ps) for ps in parts])
        np.add.at(out, owner, logs[[place[p] for ps in parts for p in ps]])
        return out

    def _some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.code) > MEMORY:
            self._forget()
        code, known, codes, counts = self.code, len(self.code), [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            tokens = text.split()
            counts[k] = len(tokens)
            codes += [code.setdefault(t, len(code)) for t in tokens]
        if len(code) > known:
            fresh = list(islice(reversed(code), len(code) - known))[::-1]
            self.score = np.vstack([self.score, self._learn(fresh)])
            self.letters = np.append(self.letters, [sum(map(len, LETTERS.findall(t))) for t in fresh])
        total, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        filled = np.flatnonzero(counts)
        if len(filled):
            starts = np.cumsum(counts)[filled] - counts[filled]
            total[filled] = np.add.reduceat(self.score[np.array(codes)], starts, axis=0)
            letters[filled] = np.add.reduceat(self.letters[np.array(codes)], starts)
        return total, letters

    def __call__(self, texts: list[str | None]) -> pd.DataFrame:
        langs, scores, means, step, chars = [], [], [], [], 0
        for k, text in enumerate(texts):
            step.append(text or "")
            chars += len(text or "")
            if chars >= 2_000_000 or k == len(texts) - 1:
                total, letters = self._some(step) if self.languages else (None, [0] * len(step))
                for i, n in enumerate(letters):
                    best = int(np.argmax(total[i])) if n else -1
                    langs.append(self.languages[best] if n else UNKNOWN)
                    scores.append(float(1.0 / np.exp(total[i] - total[i, best]).sum()) if n else 0.0)
                    means.append(float(total[i, best] / n) if n else None)
                step, chars = [], 0
        return pd.DataFrame({"lang_pred": langs, "score": scores, "per_letter": pd.Series(means, dtype=float)})


def predict(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``per_letter`` (mean log probability of
    the predicted language per letter; NULL where there is none) for a text column."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, per_letter double")
    def score_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for series in batches:
            yield scorer([t if isinstance(t, str) else None for t in series.tolist()])
        del scorer
        release_memory()

    return score_texts.asNondeterministic()(text)  # so that a filter on it never runs it twice
