import pytest

from portalforge.llm.common import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers_can_import(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, lang, source) -> a documents table."""
    def make(rows):
        rows = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        return spark.createDataFrame(rows, DOCUMENTS)
    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    one id with two texts, tied texts."""
    long_text = " ".join(f"word{i % 997} und{i % 13}" for i in range(60_000))
    return documents([
        (0, None, None, None), (None, "a text without an id", "en", "src0"), (None, None, None, None),
        (1, "", "en", "src0"), (2, "   \n\t ", "en", "src1"), (3, "short", "de", None),
        (4, "short", "de", "src1"), (5, long_text, "en", "src0"), (6, long_text + " tail", "en", "src0"),
        (7, "the same row twice", "fr", "src2"), (7, "the same row twice", "fr", "src2"),
        (8, "one id first text of the two", "fr", "src2"), (8, "one id another text altogether", "fr", "src2"),
        (9, "naïve Ünïcödé 漢字 🙂 text", "es", "src3"), (10, "!!! ??? ...", "es", "src3")])


CLASHING = ["score", "predicted", "held_out", "class_id", "node", "a", "b", "key1", "bucket", "id", "key", "kept", "y",
            "n_tokens", "epoch", "domain", "tokens", "budget", "mix_key", "item_id", "cosine", "places", "gram", "rank"]


@pytest.fixture(scope="session")
def clashing():
    """The same table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return lambda df: df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
