import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, spans string, tie string, label string, n long, kept int"
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree and say nothing at all about it "


def numbered(start: int, n: int) -> str:
    return " ".join(f"w{start + k}" for k in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty, blank, very long and non-ASCII texts, ties, repeated rows, near copies, clashing columns."""
    base = numbered(0, 60)
    texts = [
        (1, PROSE * 3 + base, "en", "b"),
        (2, PROSE * 3 + base, "en", "a"),
        (3, PROSE * 3 + base.replace("w30 ", "x "), "en", None),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \t\n\x0b\r\x0c ", "de", "a"),
        (7, "nur ein kurzer Satz", "de", "a"),
        (8, numbered(1000, 30_000), "en", "b"),
        (9, "Straße\u00a0mit\u3000Räumen  😀 café\n\n  doppelt", "de", "b"),
        (9, "Straße\u00a0mit\u3000Räumen  😀 café\n\n  doppelt", "de", "b"),
        (None, numbered(5000, 80), None, "c"),
        (None, numbered(6000, 80), "fr", "c"),
        (12, "mail a.b@c.example.org from 10.0.0.1 or +1 (555) 555-1234, card 4111 1111 1111 1111, bad 300.1.1.1", "en", "c"),
        (13, 'password="abcdefghijkl" AKIAABCDEFGHIJKLMN0 deadbeefdeadbeef secret=token:abcdefghijklmnop', "en", "c"),
        (14, "x" * 5000, "en", "c"),
        (15, (PROSE + "\n") * 6, "en", "b"),
        (16, "| a | b |\n" * 40, "en", "b"),
    ]
    rows = [(i, t, la, s, None, None, "x", None, "y", None, None) for i, t, la, s in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3, F.xxhash64("text"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
