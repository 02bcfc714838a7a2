import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Build a documents table from (doc_id, text[, lang[, source]]) rows."""

    def build(rows):
        full = [(r[0], r[1], *(r[2:] + ("en", "src0")[len(r) - 2:])) for r in map(tuple, rows)]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCS)

    return build


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
