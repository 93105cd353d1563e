"""Fill-in-the-middle against a plain version with the units' pattern, and the rank index on its own."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesprep.llm import fim

UNITS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plainly(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    x = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, which, order = (int(x[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or which % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((one % (n + 1), two % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if order % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=3000), st.booleans())
def test_index_is_exact(steps, jump):
    offsets = np.cumsum(np.array([0, *steps, *([1 << 30] if jump else [])], np.int64))
    index = fim.fit(offsets)
    assert index.residuals.dtype == np.int8 and len(index.residuals) == len(offsets)
    assert (index.offsets(np.arange(len(offsets))) == offsets).all()


def test_residuals_stay_within_the_bound_of_the_fit():
    steps = np.random.default_rng(1).integers(1, 14, 2_000_000)
    offsets = np.cumsum(np.append(0, steps))
    index = fim.fit(offsets)
    assert (index.offsets(np.arange(len(offsets))) == offsets).all()
    assert np.abs(index.residuals.astype(int)).max() <= fim.ERROR + 2
    assert len(index.first) < len(offsets) / 200


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85 abé日<P>SM", max_size=60), st.integers(0, 10**6))
def test_units_and_outputs(text, doc_id):
    assert fim.boundaries(text.encode()).tolist() == np.cumsum([0, *(len(u.encode()) for u in UNITS.findall(text))]).tolist()
    n, form, prefix, middle, output = fim.reform(doc_id, text.encode(), fim.Settings())
    assert (doc_id, n, form, prefix, middle, output.decode()) == plainly(doc_id, text)


@pytest.fixture(scope="module")
def many(spark, awkward):
    """The awkward rows, and enough others for every form."""
    more = [(i, f"{'x ' * (i % 7)}one two {i}{' ' * (i % 3)}<{'PSM'[i % 3] if i % 11 == 0 else 'Q'}>") for i in range(100, 400)]
    return awkward.select("doc_id", "text", "score").unionByName(spark.createDataFrame([(*r, "x") for r in more], "doc_id long, text string, score string"))


def test_against_the_plain_version(many):
    made = fim.transform(many)
    rows = sorted(made.collect(), key=str)
    assert rows == sorted((plainly(r.doc_id, r.text) for r in many.collect()), key=str)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_outputs_give_back_their_texts(many):
    again = fim.transform(many).select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t"))
    assert sorted(again.collect(), key=str) == sorted(((r.doc_id, r.text or "") for r in many.collect()), key=str)


def test_other_marks_and_an_empty_table(many, empty):
    marks = ("[pre]", "[post]", "[mid]")
    made = fim.transform(many, fim.Settings(seed=7, cut=100, suffix_first=50, marks=marks))
    again = made.select("doc_id", fim.restored(F.col("output"), F.col("form"), marks).alias("t"))
    assert sorted(again.collect(), key=str) == sorted(((r.doc_id, r.text or "") for r in many.collect()), key=str)
    assert fim.transform(empty).collect() == []
