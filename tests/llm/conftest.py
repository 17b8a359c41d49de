import pytest

from tests.conftest import SMALL

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like working ones."""
    prose = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] for i in range(120))
    rows = [(1, None, "en", None), (2, "", None, 1), (3, " \n\t ", "en", 2), (4, prose, "en", 3), (4, prose, "en", 3),
            (None, prose + " more", None, None), (None, None, None, None), (5, "x", "fr", 5), (6, "é" * 50 + "🙂", "fr", 6),
            (7, (prose + "\n") * 400, "en", 7), (8, "a" * 30_000, "en", 8), (9, prose.upper(), "de", 9), (10, "\x00\x1c \x85", "de", 10),
            (11, "1" * 5000 + " +1 555 " + "1." * 3000 + "@" * 50, "de", 11)]
    names = ("__text", "__row", "row", "label", "segment", "base", "spans", "kept", "n_words", "ids", "n", "copy")
    full = [(*r, *(f"{c}{k}" for c in names)) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
