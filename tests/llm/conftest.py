import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) rows; further columns carry names that operators use themselves."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in ("digest", "uid", "token", "n", "a", "b", "node", "kind", "members", "kept"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df.repartition(parts) if rows else df
    return make
