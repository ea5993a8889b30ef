import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, keep_id string, kept_id string, "
    "norm string, row_id string, spans string, key string, host string, line string, _lang string, _row string, gone_id string, "
    "start string, cell string, n string"
)


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text[, lang[, source]]), with extra columns whose names the operators use inside."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "s")[len(row) - 2 :])
            full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * 15))
        return spark.createDataFrame(full, SCHEMA)

    return make
