"""Quality rules: counts per document, and how many documents of a host repeat its lines."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WHITE, map_columns, text_of, written

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: A line of more distinct documents of one host than this is boilerplate there.
MAX_DOCUMENTS = 30
#: A document is depleted if less than this percentage of its words is left without such lines.
MIN_LEFT_PERCENT = 30

#: What the line rule counts, and the column that tells one from another.
DOCUMENTS, TEXTS = "documents", "texts"
_UNITS = {DOCUMENTS: "doc_id", TEXTS: "text_hash"}

SPACES = "\x20\t\n\x0b\x0c\r"
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` words that the text has twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    n, covered_to = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            n += i + width - max(i, covered_to)
            covered_to = i + width
    return n


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the five counts of each row; null texts have no words. Nothing is shuffled."""

    def start():
        return lambda ids, texts: (ids, *zip(*(text_counts(text or "") for text in texts))) if ids else ([],) * 6

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_columns(chosen, f"doc_id {kind}, {COUNTS}", start)


def _lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """host, doc_id, digest of the text, and for each different line its hash, words and number."""
    text = text_of(text_col)
    line = F.trim(F.regexp_replace(F.lower(F.col("raw")), WHITE, " "))
    raw = docs.select(
        F.col(host_col).alias("host"),
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.explode(F.split(text, "\n")).alias("raw"),
    )
    return raw.select("host", "doc_id", "text_hash", line.alias("line")).filter("line <> ''").select(
        "host",
        "doc_id",
        "text_hash",
        F.xxhash64("line").alias("line_hash"),
        F.size(F.split("line", " ")).cast("bigint").alias("words"),
    )


def frequent_lines(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    unit: str = DOCUMENTS,
) -> DataFrame:
    """host, line_hash, n_documents of the lines that more than ``max_documents`` documents of a host have.

    ``unit="documents"`` counts different ids. ``unit="texts"`` counts documents of one text once, for tables
    whose copies are left to another operator. Counted in two steps, so that no key brings all rows of a line
    together: first the different (host, line, unit), then their number; both merge in the map tasks.
    """
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {sorted(_UNITS)}, not {unit!r}")
    once = _lines(docs, id_col, text_col, host_col).groupBy("host", "line_hash", _UNITS[unit]).agg(F.lit(1).alias("one"))
    counts = once.groupBy("host", "line_hash").agg(F.count("*").alias("n_documents"))
    return counts.filter(F.col("n_documents") > max_documents)


def quality_rules(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    unit: str = DOCUMENTS,
) -> DataFrame:
    """doc_id, the five counts, n_line_words (words in frequent lines), base_failed, kept.

    Frequent lines are stored once, as most lines are not; the lines of the documents find them by
    an ordinary join, which Spark may split where one line has many rows. A document is kept if it
    passes the base rules and enough of its words stand in other lines.

    ``unit`` is what the line rule counts, see ``frequent_lines``. By documents, copies count each: a page that stands in
    more than ``max_documents`` copies on one host has frequent lines only, and all its copies go.

    Rows that share an id are one document for the line rule. A null id or host is a value like any
    other; a null text has no words and fails. An empty table gives no rows.
    """
    counts = document_counts(docs, id_col, text_col)
    frequent = written(frequent_lines(docs, max_documents, id_col, text_col, host_col, unit), "frequent-lines")
    frequent = frequent.select(F.col("host").alias("f_host"), F.col("line_hash").alias("f_line"))
    lines = _lines(docs, id_col, text_col, host_col).drop("text_hash")
    met = lines.join(frequent, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line_hash") == F.col("f_line")))
    removed = met.groupBy(F.col("doc_id").alias("r_id")).agg(F.sum("words").alias("n_line_words"))
    all_ = counts.join(removed, F.col("doc_id").eqNullSafe(F.col("r_id")), "left").drop("r_id")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return (
        all_.withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("bigint")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (100 * left >= min_left_percent * F.col("n_words")))
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def clean_text(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id and the text without the lines in ``frequent``, in order; a document may end up empty."""
    text = text_of(text_col)
    line = F.trim(F.regexp_replace(F.lower(F.col("raw")), WHITE, " "))
    lines = docs.select(F.col(host_col).alias("host"), F.col(id_col).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("at", "raw"))
    hashed = lines.withColumn("line_hash", F.xxhash64(line))
    listed = frequent.select(F.col("host").alias("f_host"), F.col("line_hash").alias("f_line"), F.lit(True).alias("frequent"))
    joined = hashed.join(listed, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line_hash") == F.col("f_line")), "left")
    kept = F.when(F.col("frequent").isNull(), F.struct("at", "raw"))
    parts = joined.groupBy("doc_id").agg(F.sort_array(F.collect_list(kept)).alias("lines"))
    return parts.select("doc_id", F.array_join(F.transform("lines", lambda x: x["raw"]), "\n").alias("text"))
