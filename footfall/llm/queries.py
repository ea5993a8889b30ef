"""The queries of the text operators, each over its whole table, and the SQL that some are checked by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, exact_dedup, jaccard_join, kneser_ney, packing, pii, quality_rules, ranked_search, sentence_dedup, suffix_dedup
from footfall.llm import token_counts, warc, whitening
from footfall.llm.common import map_columns, read_documents
from footfall.session import scratch_dir

#: Names of installed public vocabularies; a path would do as well.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect_pii(read_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(kind) for kind in pii.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser_ney.quality_classifier(read_documents(spark, sf_dir), labels)


def op4_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_dedup.sentence_span_dedup(read_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_sentences",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.suffix_array_dedup(read_documents(spark, sf_dir))
    n_removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        "doc_id",
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read_documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after two cleaning steps: personal data becomes a mark, and
    lines that an earlier line of the document repeats go."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    edited = token_counts.edited_counts(cleaning_edits(docs), BYTE_BPE)
    return edited.select("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "chars_reencoded", F.sha2("text", 256).alias("text_sha256"))


def cleaning_edits(docs: DataFrame) -> DataFrame:
    """doc_id, text, edits, which do not overlap: spans in a line that goes are not edited by themselves."""

    def start():
        return lambda ids, texts: (ids, texts, [line_and_span_edits(text or "") for text in texts])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(docs.select("doc_id", "text"), f"doc_id {kind}, text string, edits {token_counts.EDITS}", start)


def line_and_span_edits(text: str) -> list[dict]:
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        end = at + len(line)
        if line.strip() and line in seen:
            edits.append({"start": at - 1, "end": end, "text": ""})
        seen.add(line)
        at = end + 1
    marks, until = [], 0
    gone = iter(edits)
    line = next(gone, None)
    for span in pii.find_spans(text):
        while line and line["end"] <= span.start:
            line = next(gone, None)
        if span.start >= until and not (line and line["start"] < span.end):
            marks.append({"start": span.start, "end": span.end, "text": f"[{span.kind.upper()}]"})
            until = span.end
    return sorted(edits + marks, key=lambda edit: edit["start"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_documents(spark, sf_dir), WORD_BPE)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(read_documents(spark, sf_dir), BYTE_BPE)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc-archive")
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    facts = warc.read_record_facts(spark, folder)
    return facts.select("page_id", F.col("n_payload").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


QUERIES = (
    op1_exact_dedup,
    op2_pii,
    op3_quality_classifier,
    op4_sentence_dedup,
    op5_suffix_array_dedup,
    op6_jaccard_join,
    op7_token_counts,
    op8_packing,
    op9_quality_rules,
    op10_bpe,
    op11_ranked_search,
    op12_whitening,
    op13_warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


OP1 = r"""
with rows as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from rows join (
    select text_sha256, min(doc_id) as keep_id, count(*) as group_size from rows group by text_sha256
) using (text_sha256)
"""


OP6 = r"""
with recursive texts as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
    from texts
),
rows as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
    select a.doc_id as a, b.doc_id as b from rows a join rows b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, a.n, b.doc_id, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select doc_id, len(s) as n_shingles, least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) as component_id
from sets
"""

OP9 = r"""
with base as (
    select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
raw as (select doc_id, source, text, unnest(string_split(text, chr(10))) as line from base),
lines as (
    select *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) as norm from raw
    where regexp_matches(line, '[^\x20\x09-\x0D]')
),
dups as (select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id),
frequent as (select source, norm from lines group by source, norm having count(distinct doc_id) > 30),
met as (
    select doc_id, sum(len(string_split(l.norm, ' '))) as n_line_words
    from lines l join frequent f on f.source is not distinct from l.source and f.norm = l.norm group by doc_id
),
windows as (
    select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from base, lateral (select unnest(range(1, len(w) - 1)) as i)
),
again as (select doc_id, g from windows group by doc_id, g having count(*) > 1),
repeated as (
    select doc_id, count(distinct i + k) as n_repeat_words from windows join again using (doc_id, g), range(0, 3) x(k) group by doc_id
),
counts as (
    select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
        cast(coalesce(n_line_words, 0) as bigint) as n_line_words
    from base left join dups using (doc_id) left join repeated using (doc_id) left join met using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * (n_words - n_line_words) >= 30 * n_words as kept
from counts
"""

_TERMS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term"""

OP11 = f"""
with words as (select doc_id, {_TERMS} from documents),
wanted as (select distinct item_id, {_TERMS} from benchmark),
sizes as (select doc_id, count(*) as n from words group by doc_id),
totals as (select count(*) as all_docs, cast(sum(n) as bigint) as all_terms from sizes),
found as (select doc_id, term, count(*) as tf from words where term in (select term from wanted) group by doc_id, term),
weights as (
    select term, cast(floor(1000 * ln(cast(2 * all_docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
    from found, totals group by term, all_docs
),
impacts as (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * all_docs) // all_terms))) as impact
    from found join weights using (term) join sizes using (doc_id), totals
),
scores as (
    select item_id, doc_id, cast(sum(impact) as bigint) as score from wanted join impacts using (term) group by item_id, doc_id
),
ranked as (
    select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

OP13 = """
with records as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
),
placed as (select *, max(page_id) over (partition by payload_digest) as keeper from records)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id <> keeper then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> keeper then keeper end as refers_to
from placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op6_jaccard_join": OP6, "op9_quality_rules": OP9, "op11_ranked_search": OP11, "op13_warc": OP13}
