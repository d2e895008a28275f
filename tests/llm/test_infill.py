"""Fill-in-middle: the skip list against prefix sums, the query against plain Python, round trips."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermatch.llm import infill, queries
from ledgermatch.llm.scratch import ship_package

SF = "/root/testdata/sf0.001"
RNG = random.Random(6)
LONG = "".join(RNG.choice("ab é€😀\n") for _ in range(300_000))
TEXTS = [(1, "plain words here"), (2, None), (3, ""), (4, "x"), (5, "has <P> in it"), (6, "nearly <P <S M> <<"), (7, LONG), (8, "😀é" * 50), (None, "no id"),
         (9, "twice"), (9, "twice"), (10, "P>S>M>"), (11, "<"), (12, " \n\n"), *[(i, f"text {i} <" + "S>" * (i % 7 == 0)) for i in range(20, 120)]]


def _want(doc_id, text, rate=90, spm=20):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(text), "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return len(text), "spm" if h4 % 100 < spm else "psm", a, b - a, sha(out), sha(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=700))
def test_descent_reaches_every_rank(lengths):
    units = infill.SkipList(np.array(lengths, np.int64))
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
    assert [units.code_points_before(k) for k in range(len(lengths) + 1)] == places.tolist()


def test_lanes_thin_out():
    units = infill.SkipList(np.ones(100_000, np.uint8))
    assert [len(w) for w, _ in units.lanes] == [100_000, 6250, 391, 25, 2]
    assert all(int(w.sum(dtype=np.int64)) == int(c.sum(dtype=np.int64)) == 100_000 for w, c in units.lanes)
    assert [units.code_points_before(k) for k in (0, 1, 15, 16, 17, 4095, 4096, 65_536, 99_999, 100_000)] == [0, 1, 15, 16, 17, 4095, 4096, 65_536, 99_999, 100_000]


@pytest.mark.parametrize("unit", ["code_point", "word", "line"])
def test_outputs_hold_whole_units_and_restore(spark, unit):
    ship_package(spark)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    df = df.withColumns({c: F.lit("mine") for c in ("id", "h1", "carry", "n", "form", "output", "c0", "c1", "empty")})
    found = infill.transform(df, unit=unit)
    rows = found.select("*", infill.restore(F.col("output"), F.col("form")).alias("again")).collect()
    assert sorted((r.doc_id, r.again) for r in rows if r.doc_id is not None) == sorted((i, t or "") for i, t in TEXTS if i is not None)
    texts = dict(TEXTS)
    for r in rows:
        if r.form != "plain":
            text, cuts = texts[r.doc_id], (r.prefix_chars, r.prefix_chars + r.middle_chars)
            if unit == "line":
                assert all(c in (0, len(text)) or text[c - 1] == "\n" for c in cuts)
            if unit == "word":
                assert all(c in (0, len(text)) or text[c - 1].isspace() and not text[c].isspace() for c in cuts)
    whole = infill.transformed(df, unit=unit)
    assert whole.columns == df.columns
    outputs = sorted(((r.doc_id, r.output) for r in rows), key=str)
    kept = whole.collect()
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=str) == outputs
    assert all(r[c] == "mine" for r in kept for c in df.columns[2:]) and [r.text for r in kept if r.doc_id == 2] == [None]


def test_query_columns_against_plain_python(spark):
    ship_package(spark)
    found = infill.transform(spark.createDataFrame(TEXTS, "doc_id long, text string"))
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, hashlib.sha256(r.output.encode()).hexdigest()) for r in found.collect()]
    assert sorted(got, key=str) == sorted(((i, *_want(i, t)[:5]) for i, t in TEXTS), key=str)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}
    with pytest.raises(ValueError):
        infill.transform(spark.range(1), unit="page")


def test_op13_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_infill(spark, SF).collect()}
    assert got == {r.doc_id: _want(r.doc_id, r.text) for r in table}
