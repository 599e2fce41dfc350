import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs or full rows, with extra columns of clashing names."""
    def make(rows, extra=True):
        full = [(r + (None, None))[:4] if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame([(d, t, l, s, None if t is None else len(t)) for d, t, l, s in full],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for c in ("fp", "node", "value", "a", "b", "n_words", "kept", "lang_pred", "spans", "start", "item_id"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "One two three"), (None, "one two three"),
        (7, "word " * 50_000), (7, "word " * 50_000), (8, "x" * 200_000), (9, "é ü ß 日本語   \x00 ok")]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE
