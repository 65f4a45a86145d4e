import pytest

LONG = "word " * 30_000 + " ".join(f"w{i}" for i in range(30_000))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One"),
    (5, "one"),
    (6, "a b c d e f g h i j"),
    (7, "A b C d e f g h i j"),
    (8, "a b c d e f g h i j"),
    (8, "a b c d e f g h i j"),
    (9, LONG),
    (10, LONG + " end"),
    (None, "a b c d e f g h i j"),
    (None, None),
    (11, "é ß 漢字 😀 \x00 \ud7ff"),
]
EXTRA = ("id", "key", "part", "t", "fp", "digest", "kept", "component_id", "length", "label", "score", "host", "segment")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows and columns of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None, None, *["x"] * len(EXTRA)) for i, t in ROWS], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (7, 1, 0), (9, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
