import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows of ``documents`` from (doc_id, text) or (doc_id, text, source) tuples, with clashing extra columns."""
    def build(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:
            for c in ("row", "size", "score", "kept", "n_words", "shard", "digest", "key", "rank", "unit"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return build
