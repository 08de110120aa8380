import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts or (id, text) pairs, with columns whose names the operators use themselves."""

    def make(*rows, parts=3):
        full = []
        for k, row in enumerate(rows):
            ident, text, source = (*row, "s")[:3] if isinstance(row, tuple) else (k, row, "s")
            full.append((ident, text, "en", source, None, 7, 7, "x", 7, 7))
        schema = DOC + ", id long, size long, fp string, _mark long, shard long"
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def by_id(df, *columns):
    """Sorted rows, nulls as text."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
