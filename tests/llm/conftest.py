import random

import pytest

#: Extra columns whose names the operators use themselves.
CLASHES = (
    "digest string, body string, keep_id long, size long, key string, item int, cell int, shard int, slot long, band int, "
    "rank int, rep long, component long, score double, score2 double, lang_pred string, tail long, whole long, text_sha256 string"
)
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
WIDTH = len(SCHEMA.split(","))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """A documents table from (doc_id, text[, lang]) rows, with clashing extra columns."""
        full = [tuple(r) + (None,) * (WIDTH - len(r)) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    r = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    long = " ".join(r.choice(words) for _ in range(30_000))
    return [
        (1, "Hello World, it's a small test of things.", "en"),
        (2, "hello world, it's a small test of things.", "en"),
        (3, None, "en"),
        (4, "", None),
        (5, "   \n\t ", "de"),
        (6, long, "en"),
        (7, long + " tail", "en"),
        (7, long + " tail", "en"),
        (8, "Äpfel und Birnen " + chr(0x6771) + chr(0x4EAC) + " " + chr(0x1F44D), "de"),
        (8, "Äpfel und Birnen " + chr(0x6771) + chr(0x4EAC) + " " + chr(0x1F44D), "de"),
        (9, "äpfel und birnen", "de"),
        (10, "a", None),
        (None, "hello world, it's a small test of things.", "en"),
        (None, None, None),
    ]
