"""The pipeline's stages: what each keeps, and all of them against plain versions."""

import random

import corpus_pipeline
from footfall.llm import pii
from tests.conftest import SF
from tests.llm.test_dedup import brute_components
from tests.llm.test_text import check_packing


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    states = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        states.append(stage(spark, states[-1], SF).cache())
        assert states[-1].columns == columns
    texts = [{r.doc_id: r.text for r in state.select("doc_id", "text").collect()} for state in states]
    raw, good, single, far, clean = texts
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    trusted = [i for i in raw if labels.get(i) == (1, 0)]
    assert set(good) <= set(raw) and len(set(trusted) & set(good)) >= 0.99 * len(trusted)
    first = {}
    for i in sorted(good):
        first.setdefault(" ".join(good[i].replace("\t", " ").split(" ")), i)
    assert set(single) == {first[" ".join(good[i].replace("\t", " ").split(" "))] for i in good}
    components = brute_components(single, 5, 80)
    assert set(far) == {i for i, (_, root) in components.items() if root == i}
    assert clean == {i: pii.redacted(t, pii.find_spans(t)) for i, t in far.items()}
    rows = corpus_pipeline.STAGES[-1][1](spark, states[-1], SF).collect()
    check_packing(rows, clean, 4096)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert {(r.doc_id, r.doc_tokens) for r in corpus_pipeline.run(spark, SF).collect()} == {(r.doc_id, r.doc_tokens) for r in rows}
    assert all(key(r) for r in rows)


def test_stages_on_odd_rows(spark, make_docs):
    text = "Er ist in der Stadt und das ist gut so, denn hier sind alle Wege kurz und schön. " * 3
    docs = make_docs([(1, text), (2, text), (None, text + "x"), (3, None), (4, ""), (5, text + " more")])
    for rows in (docs, docs.limit(0)):
        state = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            state = stage(spark, state, SF)
            assert state.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, state, SF)
        assert packed.count() >= 0


def test_quality_stage_judges_every_script(spark, make_docs, tmp_path):
    """Trusted documents of a language in another alphabet stay; one of as many letters that none of them has goes."""
    rng = random.Random(8)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    known, other = ("мама", "мыла", "раму", "утро", "снег"), ("щъюэ", "фцхж", "ёыэщ", "жхцф", "юэщъ")
    docs = make_docs([(i, text(known), "ru") for i in range(80)] + [(100, text(known), "ru"), (101, text(other), "ru")])
    spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()}
    assert 101 not in kept and 100 in kept and len(kept) >= 80
