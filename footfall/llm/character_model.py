"""Interpolated modified Kneser-Ney over characters: counts, weights and scores are Spark tables.

The probability of a text is a sum over its n-grams. Where an n-gram was seen in training its cost is -ln p; where it
was not, the cost is that of the n-gram one shorter plus -ln of the share that the context leaves to it. So with

* for each n-gram seen, ln(share of its context * p one order below) - ln p, and
* for each context seen, -ln of its share

as the weight of that n-gram, a text costs the sum of the weights of all n-grams of 1 to ORDER symbols in it, and a
constant per symbol. An n-gram that training never saw weighs nothing. Thus one join of the texts' n-grams with the
table of weights gives the cost of every text, however large the table is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, record_batch, text_of, written

#: Symbols in an n-gram: four UTF-16 units are a 64-bit key, so keys are exact.
ORDER = 4
BITS = 16
UNITS = 1 << BITS
#: Stand before and behind each text. Neither is a character; where a text has one, it is read as the replacement character.
START, END, REPLACEMENT, SPACE = 0xFFFF, 0xFFFE, 0xFFFD, 0x20
#: Texts are dealt into so many parts, and each is scored by the model of the other parts: no text is known to its model.
FOLDS = 5
#: The most frequent n-grams, at most so many, go to every task; the others meet the texts' n-grams in a shuffled join.
#: This bounds the broadcast and takes the hot keys out of the join. It changes no result.
HOT = 1 << 17
#: N-grams that a task handles at a time, about.
CHUNK = 400_000


def fold_of(text: str) -> int:
    """Copies of a text are in one fold."""
    return crc32(text.encode("utf-8", "surrogatepass")) % FOLDS


@lru_cache(1)
def symbols() -> np.ndarray:
    """What each UTF-16 unit is read as: itself, but all white space as a space, and digits as 0, as numbers tell nothing of a text."""
    read = np.arange(UNITS, dtype=np.uint16)
    for c in range(UNITS):
        if chr(c).isspace():
            read[c] = SPACE
        elif chr(c).isdecimal():
            read[c] = ord("0")
    read[[START, END]] = REPLACEMENT
    return read


def windows(text: str) -> np.ndarray:
    """The longest n-gram that ends with each symbol, as a number: first that of the start, then of each unit, then of
    the end. A run of white space is one space. Without a symbol there is none."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    units = symbols()[units]
    white = units == SPACE
    units = units[~(white & np.concatenate(([True], white[:-1])))] if len(units) else units
    if not len(units):
        return np.zeros(0, np.uint64)
    padded = np.concatenate((np.full(ORDER, START), units, [END])).astype(np.uint64)
    codes = padded[: 1 - ORDER].copy()
    for k in range(1, ORDER):
        codes = (codes << np.uint64(BITS)) | padded[k : len(padded) - ORDER + 1 + k]
    return codes


def _tag(size: int) -> int:
    """What a key of ``size`` symbols has in the places of those it lacks: the end, behind which nothing stands."""
    tag = sum(END << (BITS * i) for i in range(size, ORDER))
    return tag - (1 << 64) if tag >> 63 else tag


def _mask(size: int) -> int:
    return (1 << (BITS * size)) - 1


def shorter(codes: np.ndarray, size: int) -> np.ndarray:
    """Keys of the last ``size`` symbols."""
    return codes if size == ORDER else (codes & np.uint64(_mask(size))) | np.uint64(_tag(size) % (1 << 64))


def _suffix(code: str, size: int) -> Column:
    """The key of the last ``size`` symbols."""
    return F.col(code).bitwiseAND(F.lit(_mask(size))).bitwiseOR(F.lit(_tag(size)))


def _context(code: str, size: int) -> Column:
    """Of an n-gram of size + 1 symbols, the key of all but the last."""
    return F.shiftrightunsigned(code, BITS).bitwiseAND(F.lit(_mask(size))).bitwiseOR(F.lit(_tag(size)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def count_ngrams(texts: DataFrame) -> DataFrame:
    """fold, code, n of all longest n-grams of the column ``text``, summed within each task."""
    schema = "fold int, code bigint, n bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[] for _ in range(FOLDS)]  # the counts so far, and n-grams not counted yet
        fresh = [0] * FOLDS

        def settle(fold: int) -> int:
            total[fold] = [_merged(total[fold])]
            fresh[fold] = 0
            return len(total[fold][0][0])

        def rows(fold: int) -> pa.RecordBatch:
            codes, n = total[fold][0]
            total[fold] = []
            return record_batch((np.full(len(codes), fold, np.int32), codes.view(np.int64), n), arrow)

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                codes = windows(text)[1:] if text else ()
                if not len(codes):
                    continue
                fold = fold_of(text)
                total[fold].append((codes, np.ones(len(codes))))
                fresh[fold] += len(codes)
                if fresh[fold] > CHUNK and settle(fold) > 2 * CHUNK:
                    yield rows(fold)
        for fold in range(FOLDS):
            if total[fold]:
                settle(fold)
                yield rows(fold)

    return texts.select("text").mapInArrow(run, schema).groupBy("fold", "code").agg(F.sum("n").alias("n"))


def usable_discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how often the counts 1 to 4 occur; fixed ones where these leave nothing to
    n-grams that were not seen, or more than there is."""
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
        if all(0 < d <= most for most, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


def _each(make) -> list[Column]:
    return [make(fold) for fold in range(FOLDS)]


def _discount(of_fold: list[tuple[float, float, float]]):
    def of(fold: int) -> Column:
        n, (d1, d2, d3) = F.col(f"n_{fold}"), of_fold[fold]
        return F.when(n > 2, F.lit(d3)).when(n == 2, F.lit(d2)).when(n == 1, F.lit(d1)).otherwise(F.lit(0.0))

    return of


def _exact(weight: Column) -> Column:
    """To 30 binary places, so that sums of weights are the same in any order."""
    return F.round(weight * (1 << 30)) / (1 << 30)


def ngram_weights(counts: DataFrame) -> tuple[DataFrame, list[float]]:
    """(code, w_0.., seen) for all n-grams and contexts, and the cost per symbol that the weights come on top of.

    Column ``w_<fold>`` belongs to the model of all other folds. A row holds an n-gram in all models, so all folds are
    fitted in one set of joins: each n-gram meets the sums of its context, and the probability one order below.
    """
    own = lambda fold: F.coalesce(F.sum(F.when(F.col("fold") == fold, F.col("n"))), F.lit(0))
    by_code = counts.groupBy("code").agg(F.sum("n").alias("seen"), *_each(lambda f: own(f).alias(f"own_{f}")))
    longest = by_code.select("code", "seen", *_each(lambda f: (F.col("seen") - F.col(f"own_{f}")).alias(f"n_{f}")))
    tables = {ORDER: written(longest, "ngrams-longest")}
    for size in range(ORDER - 1, 0, -1):
        # Below the longest an n-gram counts the different symbols before it.
        longer = tables[size + 1].groupBy(_suffix("code", size).alias("code"))
        table = longer.agg(F.sum("seen").alias("seen"), *_each(lambda f: F.count_if(F.col(f"n_{f}") > 0).alias(f"n_{f}")))
        tables[size] = written(table, f"ngrams-{size}")
    parts, below, base = [], None, [log(UNITS)] * FOLDS
    for size in range(1, ORDER + 1):
        table = tables[size]
        often = table.agg(*[F.count_if(F.col(f"n_{f}") == n) for f in range(FOLDS) for n in (1, 2, 3, 4)]).first()
        discount = _discount([usable_discounts(*often[4 * f : 4 * f + 4]) for f in range(FOLDS)])
        table = table.withColumn("context", _context("code", size - 1))
        sums = [F.sum("seen").alias("context_seen")]
        sums += _each(lambda f: F.sum(f"n_{f}").alias(f"total_{f}")) + _each(lambda f: F.sum(discount(f)).alias(f"freed_{f}"))
        share = lambda f: F.when(F.col(f"total_{f}") > 0, F.col(f"freed_{f}") / F.col(f"total_{f}"))
        contexts = table.groupBy("context").agg(*sums).select("context", "context_seen", *_each(lambda f: F.col(f"total_{f}")), *_each(lambda f: share(f).alias(f"rest_{f}")))
        contexts = written(contexts, f"ngram-contexts-{size}")
        left = lambda f: F.coalesce(_exact(-F.log(f"rest_{f}")), F.lit(0.0)).alias(f"w_{f}")
        if size == 1:
            lower = lambda f: F.lit(1 / UNITS)
            of_all = contexts.select(*_each(left)).first()
            base = [b + a for b, a in zip(base, of_all)] if of_all else base
        else:
            lower = lambda f: F.col(f"lower_{f}")
            parts.append(contexts.select(F.col("context").alias("code"), F.col("context_seen").alias("seen"), *_each(left)))
        joined = table.join(contexts, "context")
        if below is not None:
            joined = joined.withColumn("shorter", _suffix("code", size - 1)).join(below, "shorter")
        p = lambda f: (F.col(f"n_{f}") - discount(f)) / F.col(f"total_{f}") + F.col(f"rest_{f}") * lower(f)
        known = lambda f, value: F.when(F.col(f"n_{f}") > 0, value)
        gain = lambda f: F.coalesce(known(f, _exact(F.log(F.col(f"rest_{f}") * lower(f)) - F.log(p(f)))), F.lit(0.0)).alias(f"w_{f}")
        found = joined.select("code", "seen", *_each(gain), *([] if size == ORDER else _each(lambda f: known(f, p(f)).alias(f"p_{f}"))))
        found = written(found, f"ngram-gains-{size}")
        if size < ORDER:
            below = found.select(F.col("code").alias("shorter"), *_each(lambda f: F.col(f"p_{f}").alias(f"lower_{f}")))
        parts.append(found.select("code", "seen", *_each(lambda f: F.col(f"w_{f}"))))
    *short, whole = parts  # an n-gram that is a context too has both weights
    union = short[0]
    for part in short[1:]:
        union = union.unionByName(part)
    union = union.groupBy("code").agg(F.max("seen").alias("seen"), *_each(lambda f: F.sum(f"w_{f}").alias(f"w_{f}")))
    return written(union.unionByName(whole), "ngram-weights"), base


class CharacterModel:
    """Models of the column ``text`` of ``trusted``, one per fold, that score any texts."""

    def __init__(self, trusted: DataFrame):
        weights, self.base = ngram_weights(written(count_ngrams(trusted), "ngram-counts"))
        step = F.floor(F.log2("seen") * 8).cast("int")
        above, n = 1 << 30, 0
        steps = weights.groupBy(step.alias("step")).count().collect()  # a row for each eighth of a power of two
        for row in sorted(steps, key=lambda r: -r["step"]):
            if n + row["count"] > HOT:
                break
            above, n = row["step"], n + row["count"]
        self.all_hot = n == sum(row["count"] for row in steps)
        hot = weights.filter(step >= above).select("code", *_each(lambda f: F.col(f"w_{f}"))).toArrow()
        # No text is before its start, so that n-gram is known to weigh nothing.
        codes = np.append(hot.column(0).to_numpy(), _signed(START * (UNITS**ORDER - 1) // (UNITS - 1))).view(np.uint64)
        values = np.stack([np.append(hot.column(f + 1).to_numpy(), 0.0) for f in range(FOLDS)], axis=1)
        order = np.argsort(codes)
        self.hot_codes, self.hot_weights = codes[order], values[order]
        self.cold = weights.filter(step < above).select("code", F.array(*_each(lambda f: F.col(f"w_{f}"))).alias("w"))

    def scored(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` without the text, with ``_cost`` and ``_symbols``: mean minus log probability of the text's symbols
        and its end, and the number of symbols (0: there is no cost)."""
        rest = [c for c in docs.columns if c != text_col]
        rows = docs.select(F.struct(*rest).alias("_rest"), text_of(text_col).alias("_text"))
        found = written(self._hot_costs(rows), "text-costs")
        cold = found.select("_row", "_fold", F.explode(F.arrays_zip("_codes", "_counts")).alias("c")).select("_row", "_fold", F.col("c._codes").alias("code"), F.col("c._counts").alias("n"))
        weight = F.element_at("w", F.col("_fold") + 1) * F.col("n")
        sums = cold.join(self.cold, "code").groupBy("_row").agg(F.sum(weight).alias("_more"))
        total = F.col("_sum") + F.coalesce("_more", F.lit(0.0))
        cost = F.when(F.col("_symbols") > 0, total / (F.col("_symbols") + 1)).otherwise(0.0)
        joined = found.drop("_codes", "_counts").join(sums, "_row", "left")
        return joined.select("_rest.*", cost.alias("_cost"), "_symbols")

    def _hot_costs(self, rows: DataFrame) -> DataFrame:
        """A row each: what n-grams at hand cost, and the others of the text with their numbers."""
        shared = rows.sparkSession.sparkContext.broadcast((self.hot_codes, self.hot_weights, np.array(self.base), self.all_hot))
        kind = rows.schema["_rest"].dataType.simpleString()
        schema = f"_rest {kind}, _row bigint, _fold int, _symbols bigint, _sum double, _codes array<bigint>, _counts array<bigint>"
        arrow = arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, weights, base, all_hot = shared.value
            row = TaskContext.get().partitionId() << 40
            for batch in batches:
                for start, texts in _portions(batch.column(1)):
                    n = len(texts)
                    folds = np.array([fold_of(t) for t in texts], np.int32)
                    grams = [windows(t) for t in texts]
                    sizes = np.array([len(g) for g in grams])
                    sums, cold = text_costs(grams, sizes, folds, codes, weights, all_hot)
                    symbols = np.maximum(sizes - 2, 0)
                    sums = sums + base[folds] * np.maximum(sizes - 1, 0)
                    columns = [batch.column(0).slice(start, n), pa.array(np.arange(row, row + n)), folds, symbols, sums, *cold]
                    row += n
                    columns = [(c if isinstance(c, pa.Array) else pa.array(c)).cast(t) for c, t in zip(columns, arrow.types)]
                    yield pa.RecordBatch.from_arrays(columns, arrow.names)

        return rows.mapInArrow(run, schema)


def _signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def _portions(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(place, texts): the texts in parts of about CHUNK characters."""
    texts, size, start = [], 0, 0
    for i, value in enumerate(column):
        texts.append(value.as_py())
        size += len(texts[-1])
        if size > CHUNK:
            yield start, texts
            texts, size, start = [], 0, i + 1
    if texts:
        yield start, texts


def text_costs(grams: list, sizes: np.ndarray, folds: np.ndarray, codes: np.ndarray, weights: np.ndarray, all_hot: bool, chunk: int = 2 * CHUNK):
    """Sum of the weights at hand for each text, and the n-grams without one: a list of keys and one of numbers per text.

    A long text is done a part at a time.
    """
    every, owners = np.concatenate(grams), np.repeat(np.arange(len(sizes)), sizes)
    sums, missed = np.zeros(len(sizes)), []
    for at in range(0, len(every), chunk):
        owner = owners[at : at + chunk]
        whole, where = np.unique(every[at : at + chunk], return_inverse=True)
        found = np.zeros((len(whole), FOLDS))
        for size in range(1, ORDER + 1):
            keys = shorter(whole, size)
            place = np.minimum(np.searchsorted(codes, keys), len(codes) - 1)
            hit = codes[place] == keys
            found += np.where(hit[:, None], weights[place], 0.0)
            if not all_hot:
                open_ = np.flatnonzero(~hit[where])
                missed.append(_summed(owner[open_], keys[where[open_]], np.ones(len(open_), np.int64)))
        sums += np.bincount(owner, found[where, folds[owner]], len(sizes))
    owner, keys, counts = _summed(*map(np.concatenate, zip(*missed))) if missed else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes))))).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (keys.view(np.int64), counts)]
    return sums, lists


def _summed(owner: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text and key once, in order."""
    by = np.lexsort((keys, owner))
    owner, keys, counts = owner[by], keys[by], counts[by]
    first = np.flatnonzero(np.concatenate(([len(keys) > 0], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))))
    return owner[first], keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]
