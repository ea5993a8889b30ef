"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is that of ``character_model``; the one of fixed size over classes of characters is here.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.character_model import FOLDS, CharacterModel, fold_of
from footfall.llm.common import arrow_schema, bound_batches, record_batch, text_of, written

#: Symbols in an n-gram. With the alphabet below, tables have at most SYMBOLS ** ORDER rows, whatever the text.
ORDER = 4
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PAD, SPACE, FIRST_LETTER = 0, 1, 2
CAPITAL, OTHER_LETTER, DIGIT, STOP, QUOTE, BAR, MARK = range(FIRST_LETTER + len(LETTERS), FIRST_LETTER + len(LETTERS) + 7)
SYMBOLS = MARK + 1

#: A language's limit: this quantile of how far its trusted documents lie above their median.
QUANTILE = 0.99
#: How far a text lies above the median counts as if so many symbols of the median followed: little
#: text is little evidence.
PRIOR_SYMBOLS = 200
#: Languages with fewer trusted documents take the quantiles of all.
MIN_TRUSTED = 50


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """The symbol of each code point: base letters, capitals as one, and classes of the rest."""
    table = np.full(0x110000, MARK, np.uint8)
    table[0x250:] = OTHER_LETTER
    for c in range(0x250):
        char = chr(c)
        base = unicodedata.normalize("NFD", char)[0]
        if char.isspace():
            table[c] = SPACE
        elif char.isupper():
            table[c] = CAPITAL
        elif base in LETTERS:
            table[c] = FIRST_LETTER + LETTERS.index(base)
        elif char.isalpha():
            table[c] = OTHER_LETTER
        elif char.isdigit():
            table[c] = DIGIT
        elif char in ".,;:!?":
            table[c] = STOP
        elif char in "'\"()-":
            table[c] = QUOTE
        elif char == "|":
            table[c] = BAR
    return table


def ngram_codes(text: str) -> np.ndarray:
    """The n-gram that ends with each symbol, as a number; a run of white space is one space."""
    symbols = symbol_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int32)
    space = symbols == SPACE
    symbols = symbols[~(space & np.concatenate(([True], space[:-1])))] if len(symbols) else symbols
    padded = np.concatenate((np.zeros(ORDER - 1, np.int32), symbols))
    codes = np.zeros(len(symbols), np.int32)
    for k in range(ORDER):
        codes = codes * SYMBOLS + padded[k : k + len(symbols)]
    return codes


def count_ngrams(texts: DataFrame) -> DataFrame:
    """fold, code, n of all n-grams of the column ``text``; each task sends each n-gram of a fold once."""
    schema = "fold int, code int, n bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for value in batch.column(0):
                if text := value.as_py():
                    codes, counts = np.unique(ngram_codes(text), return_counts=True)
                    table = total.setdefault(fold_of(text), np.zeros(SYMBOLS**ORDER, np.uint32))  # a task has less text than that
                    table[codes] += counts.astype(np.uint32)
        for fold in list(total):
            table = total.pop(fold)
            seen = np.flatnonzero(table)
            yield record_batch((np.full(len(seen), fold, np.int32), seen.astype(np.int32), table[seen].astype(np.int64)), arrow)

    return texts.select("text").mapInArrow(run, schema).groupBy("fold", "code").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> Column:
    """Modified Kneser-Ney discounts of the counts 1, 2 and more in each fold, from how often the counts 1 to 4 occur there."""
    rows = counts.filter("n <= 4").groupBy("fold", "n").count().collect()  # at most four rows a fold
    of_fold: dict[int, dict[int, int]] = {}
    for fold, n, count in rows:
        of_fold.setdefault(fold, {})[n] = count
    result = F.lit(None).cast("double")
    for fold, of in of_fold.items():
        d1, d2, d3 = (F.lit(d) for d in modified_discounts(*(of.get(i, 0) for i in (1, 2, 3, 4))))
        own = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        result = F.when(F.col("fold") == fold, own).otherwise(result)
    # A fold without such counts has the values of one with none of either.
    d1, d2, d3 = modified_discounts(0, 0, 0, 0)
    return F.coalesce(result, F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3))


def modified_discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    bound = lambda d, most: min(max(d, 0.0), most)
    return bound(1 - 2 * y * n2 / n1, 1.0), bound(2 - 3 * y * n3 / n2, 2.0), bound(3 - 4 * y * n4 / n3, 3.0) if n3 else 1.5


def probabilities(highest: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each order from 1: (fold, code, p) of the n-grams seen, and (fold, context, rest) of their contexts.

    ``highest`` has the counts of the longest n-grams (fold, code, n): a model per fold, all of them in one set of
    joins. Below it an n-gram counts the different symbols before it. The counts are dealt out by n-gram and joined
    with the sums of their contexts and with the probabilities one order below; ``rest`` is the share that a context
    leaves to the lower order.
    """
    counts = [highest]
    for order in range(ORDER - 1, 0, -1):
        counts.insert(0, counts[0].groupBy("fold", (F.col("code") % SYMBOLS**order).alias("code")).agg(F.count("*").alias("n")))
    found, rests = [], []
    for order, table in enumerate(counts, 1):
        table = written(table, f"counts-{order}")
        discount = discounts(table)
        table = table.withColumn("context", (F.col("code") / SYMBOLS).cast("int"))
        contexts = table.groupBy("fold", "context").agg(F.sum("n").alias("total"), F.sum(discount).alias("freed"))
        contexts = written(contexts.select("fold", "context", "total", (F.col("freed") / F.col("total")).alias("rest")), f"contexts-{order}")
        joined = table.join(contexts, ["fold", "context"]).withColumn("own", (F.col("n") - discount) / F.col("total"))
        if order == 1:
            p = F.col("own") + F.col("rest") / SYMBOLS
        else:
            lower = found[-1].select("fold", F.col("code").alias("shorter"), F.col("p").alias("p_lower"))
            joined = joined.withColumn("shorter", F.col("code") % SYMBOLS ** (order - 1)).join(lower, ["fold", "shorter"])
            p = F.col("own") + F.col("rest") * F.col("p_lower")
        found.append(written(joined.select("fold", "code", p.alias("p")), f"p-{order}"))
        rests.append(contexts.select("fold", "context", "rest"))
    return found, rests


def fit(trusted: DataFrame) -> np.ndarray:
    """Minus log of the probability of each possible n-gram's last symbol.

    All trusted text counts. The tables that come to the driver have at most SYMBOLS ** ORDER rows,
    however much text there is.
    """
    counts = count_ngrams(trusted).groupBy("code").agg(F.sum("n").alias("n"))
    return _fit(counts.select(F.lit(0).alias("fold"), "code", "n"), 1)[0]


def fit_folds(trusted: DataFrame) -> np.ndarray:
    """For each fold the model of all other folds."""
    own = [F.coalesce(F.sum(F.when(F.col("fold") == fold, F.col("n"))), F.lit(0)) for fold in range(FOLDS)]
    by_code = count_ngrams(trusted).groupBy("code").agg(F.array(*own).alias("own"), F.sum("n").alias("total"))
    rows = [F.struct(F.lit(fold).alias("fold"), (F.col("total") - F.col("own")[fold]).alias("n")) for fold in range(FOLDS)]
    return _fit(by_code.select("code", F.inline(F.array(*rows))).filter("n > 0").select("fold", "code", "n"), FOLDS)


def _fit(counts: DataFrame, folds: int) -> np.ndarray:
    found, rests = probabilities(written(counts, "ngram-counts"))
    tables = []
    for fold in range(folds):  # a fold at a time comes to the driver
        p = np.full(1, 1 / SYMBOLS)
        for order, (seen, rest) in enumerate(zip(found, rests), 1):
            size = SYMBOLS**order
            left = np.ones(size // SYMBOLS)
            context, share = _arrays(rest, fold)
            left[context] = share
            p = np.repeat(left, SYMBOLS) * (p[np.arange(size) % len(p)])
            code, value = _arrays(seen, fold)
            p[code] = value
        tables.append(-np.log(p).astype(np.float32))
    return np.stack(tables)


def _arrays(table: DataFrame, fold: int) -> tuple[np.ndarray, np.ndarray]:
    arrow = table.filter(F.col("fold") == fold).drop("fold").toArrow()
    return arrow.column(0).to_numpy(), arrow.column(1).to_numpy()


def scored(docs: DataFrame, tables: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_cost`` and ``_symbols``: mean minus log probability of the text's symbols, and their number.

    Each text is scored by the table of its fold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    kind = arrow_schema("cost double, symbols bigint")

    @F.arrow_udf("cost double, symbols bigint")
    def score(texts: pa.Array) -> pa.Array:
        costs, symbols = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for i, value in enumerate(texts):  # one text at a time as a Python string
            text = value.as_py()
            cost, n = cost_of(text, shared.value[fold_of(text)])
            costs[i], symbols[i] = cost / n if n else 0.0, n
        return pa.StructArray.from_arrays([pa.array(costs), pa.array(symbols)], fields=list(kind))

    found = docs.withColumn("_score", score(text_of(text_col)))
    return found.withColumn("_cost", F.col("_score.cost")).withColumn("_symbols", F.col("_score.symbols")).drop("_score")


def cost_of(text: str, table: np.ndarray) -> tuple[float, int]:
    codes = ngram_codes(text)
    return float(table[codes].sum(dtype=np.float64)), len(codes)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good and none says toxic."""
    bad = F.coalesce(F.col("quality"), F.lit(0)) != 1
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) != 0
    marked = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(bad | toxic).alias("bad"))
    return marked.filter("not bad").select("doc_id")


def _excess(median: str) -> Column:
    return (F.col("_cost") - F.col(median)) * F.col("_symbols") / (F.col("_symbols") + PRIOR_SYMBOLS)


def limits(trusted: DataFrame) -> tuple[DataFrame, float | None, float | None]:
    """(_lang, _median, _limit) per language with enough trusted documents, and both for all together.

    ``trusted`` has ``_lang``, ``_cost`` and ``_symbols`` of each trusted document.
    """
    good = written(trusted.filter("_symbols > 0").select("_lang", "_cost", "_symbols"), "trusted-scores")
    quantile = lambda column, q: F.percentile_approx(column, q, 100_000)
    median = good.groupBy("_lang").agg(quantile("_cost", 0.5).alias("_median"), F.count("*").alias("n"))
    median = written(median.filter(F.col("n") >= MIN_TRUSTED).drop("n"), "language-medians")
    placed = good.join(median, "_lang").withColumn("_excess", _excess("_median"))
    by_language = placed.groupBy("_lang", "_median").agg(quantile("_excess", QUANTILE).alias("_limit"))
    every = good.agg(quantile("_cost", 0.5).alias("m")).first()["m"]
    if every is None:
        return written(by_language, "language-limits"), None, None
    of_all = good.withColumn("_median", F.lit(every)).agg(quantile(_excess("_median"), QUANTILE).alias("q")).first()["q"]
    return written(by_language, "language-limits"), every, of_all


def judged(scores: DataFrame, by_language: DataFrame, median: float | None, limit: float | None) -> DataFrame:
    """``scores`` with ``_excess``, ``_limit`` and ``_kept``. The limits are a row per language: a small table."""
    found = scores.join(by_language.withColumnRenamed("_lang", "_l"), F.col("_lang") == F.col("_l"), "left").drop("_l")
    found = found.withColumn("_median", F.coalesce("_median", F.lit(median).cast("double")))
    found = found.withColumn("_limit", F.coalesce("_limit", F.lit(limit).cast("double")))
    found = found.withColumn("_excess", _excess("_median"))
    return found.withColumn("_kept", (F.col("_symbols") > 0) & F.coalesce(F.col("_excess") <= F.col("_limit"), F.lit(True)))


class ClassModel:
    """The bounded model: symbols are classes of characters, and a table of all n-grams goes to every task."""

    def __init__(self, trusted: DataFrame):
        self.tables = fit_folds(trusted)

    def scored(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        return scored(docs, self.tables, text_col).drop(text_col)


MODELS = {"characters": CharacterModel, "classes": ClassModel}


class QualityClassifier:
    """A model of the documents that ``labels`` trusts, and the limits of each language.

    Trusted documents and others alike are scored by a model that their own text is not in, so the limits hold for
    documents that were never trusted too. ``labels`` has doc_id, quality, toxic. All trusted documents train the model and set the limits;
    without any, nothing but documents without text is rejected. A null id is never trusted; rows
    that share an id are all labelled by it. Other columns are ignored.

    ``units`` are the model's symbols: "characters" of any script, whose n-grams grow with the text and meet it in joins
    (digits are read as 0), or "classes", a coarse model of fixed size.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, text_col: str = "text", lang_col: str = "lang", units: str = "characters"):
        self.text_col, self.lang_col = text_col, lang_col
        good = trusted_ids(labels).hint("merge")  # a merge join at every size: labels grow with the documents
        bound_batches(docs.sparkSession)
        rows = docs.select("doc_id", text_of(text_col).alias("text"))
        self.docs, self.model = docs, MODELS[units](rows.join(good, "doc_id", "left_semi").select("text"))
        self.scores = self._scores(docs)
        self.by_language, self.median, self.limit = limits(self.scores.join(good, "doc_id", "left_semi"))

    def _scores(self, docs: DataFrame) -> DataFrame:
        """doc_id, _lang, _key (of the text), _cost, _symbols: a row per row."""
        rows = docs.select("doc_id", F.col(self.lang_col).alias("_lang"), _key(self.text_col).alias("_key"), text_of(self.text_col).alias("text"))
        return written(self.model.scored(rows), "scores")

    def results(self) -> DataFrame:
        """doc_id, lang, n_symbols, perplexity (null without text), excess, limit, kept: a row per row."""
        found = judged(self.scores, self.by_language, self.median, self.limit)
        perplexity = F.when(F.col("_symbols") > 0, F.exp("_cost"))
        return found.select(
            "doc_id",
            F.col("_lang").alias("lang"),
            F.col("_symbols").alias("n_symbols"),
            perplexity.alias("perplexity"),
            F.col("_excess").alias("excess"),
            F.col("_limit").alias("limit"),
            F.col("_kept").alias("kept"),
        )

    def keep(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are kept, with their columns. Rows of one id, text and language are one case."""
        scores = self.scores if docs is self.docs else self._scores(docs)
        kept = judged(scores, self.by_language, self.median, self.limit).filter("_kept").select("doc_id", "_key", "_lang")
        rows = docs.select(F.struct("*").alias("_whole"), F.col("doc_id").alias("_id"), _key(self.text_col).alias("_k"), F.col(self.lang_col).alias("_l"))
        same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_k") == F.col("_key")) & F.col("_l").eqNullSafe(F.col("_lang"))
        return rows.join(kept.hint("merge"), same, "left_semi").select("_whole.*")


def _key(text_col: str) -> Column:
    return F.unhex(F.md5(text_of(text_col)))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return QualityClassifier(docs, labels).results()
