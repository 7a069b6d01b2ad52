import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, source) tuples."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, and extra columns
    with names that operators use themselves."""
    long_text = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
    rows = [(1, None, None, "a", None), (2, "", "en", None, 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7), (4, "one", "en", "a", 3),
            (5, long_text, "en", "b", len(long_text)), (6, long_text + " end", "en", "b", 1), (7, "one", None, "a", 3), (7, "one", None, "a", 3),
            (None, "a text without an id", "en", "b", 5), (None, None, None, None, None), (8, "ünï cödé\u00a0x \U0001f600\nline\nline\n", "de", "c", 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = {c: f"cast(1 as {t}) as `{c}`" for c, t in (("n", "int"), ("id", "string"), ("host", "double"), ("size", "string"), ("bad", "int"),
             ("score", "string"), ("component", "int"), ("sketch", "int"), ("words", "int"), ("source_size", "int"), ("rate", "int"), ("__row", "int"))}
    return df.selectExpr("*", *extra.values())
