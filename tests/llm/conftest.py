from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, size string, h int, place double, score string, ids binary, node long, label int, carried int"
)

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box with heavy jugs of dark ale".split()

#: Null ids and texts, empty and very long texts, ties and repeated rows.
TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta"),
    (2, "alpha beta gamma delta epsilon zeta"),
    (3, ""),
    (4, None),
    (5, " \n\t "),
    (6, "one"),
    (7, "one"),
    (7, "one"),
    (None, "one"),
    (None, "nobody's text"),
    (8, "42 ... !!"),
    (9, " ".join(WORDS * 3000)),
    (10, " ".join(WORDS * 3000) + " end"),
    (11, "x" * 50_000),
    (12, "Über die Straße, naïve café; 中文 текст"),
    (13, "Über die Straße, naïve café; 中文 текст"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents of all awkward kinds, with columns whose names the operators use themselves."""
    rows = [(i, t, "en" if t else None, None, None, *[None] * 9) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def keyed(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
