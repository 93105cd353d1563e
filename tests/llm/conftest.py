"""Small tables with every awkward case, and the given tables at the smallest scale."""

import pytest
from llm_helpers import prose

SF = "/root/testdata/sf0.001"
#: Names that operators use for their own columns.
CLASHING = ("score", "tid", "row", "fp", "k0", "t", "kept", "N_CHARS", "sequence_id")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows and clashing extra columns."""
    base, other = prose(1, 300), prose(2, 200)
    texts = [
        (1, base),
        (2, base),
        (3, base + " end"),
        (3, base + " end"),
        (None, base),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "é" * 900 + prose(3, 50)),
        (8, prose(4, 60_000)),
        (9, other[:500] + prose(5, 100)),
        (10, prose(6, 100) + other[:500]),
        (11, "a" * 1000),
        (12, "word"),
        (None, None),
        (13, "日本語 テキスト x  " * 40),
        (14, "<|endoftext|> 's <|ENDOFTEXT|> DON'T"),
    ]
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING if c.lower() != "n_chars")
    rows = [(i, t, "en", "s", 0, *["x"] * (len(CLASHING) - 1)) for i, t in texts]
    return spark.createDataFrame(rows, fields)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
