import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, u long, kind string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]), with columns beside those the operators know."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, 7, 8, "x") for r in rows]
        return spark.createDataFrame(full, SHAPE).repartition(3)

    return make
