"""License scans against plain Python."""

import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgermatch.llm import licenses, queries  # noqa: E402
from ledgermatch.llm.licenses import ADDED, BASE, Template  # noqa: E402

SF = "/root/testdata/sf0.001"
RNG = random.Random(4)
NOTICE = next(t.text for t in ADDED if t.label == "mit-text")
LONG = " ".join(RNG.choice(["mit", "license", "apache", "general", "public", "x", "cc", "by", "nc"]) for _ in range(60_000))
FEW = NOTICE.split()
TEXTS = [
    (1, "MIT License"), (2, "the mit\tLICENSE, mit license; Apache-License"), (3, None), (4, ""), (5, " ., "), (6, LONG), (7, "mit licenses"),
    (8, "GNU General Public License general public general public license"), (9, NOTICE), (10, "x " * 50 + NOTICE + " y z " + NOTICE),
    (11, " ".join(FEW[:20] + FEW[23:])), (12, " ".join(FEW[:9])), (13, " ".join(w for i, w in enumerate(FEW) if i % 3)), (14, "mit İlicense"),
    (15, "é mit license é"), (16, "émit license"), (17, "CC BY-NC 4.0"), (None, "mit license"), (18, "mit license"), (18, "mit license"),
    (18, "apache license"), (19, "mit license " * 500), (20, "license mit"), (21, "Kapache license mit license"), (22, " ".join(FEW[:30] + ["put", "in"] + FEW[30:])),
    (23, "MIT    license"), (24, "cc by nc cc by nc nc by cc"),
]


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _scan(text):
    """The base by looking at every place; labels by diagonals of all hits, merged."""
    words, base, labels, score = _words(text), [], set(), 0.0
    for t in (*BASE, *ADDED):
        k, near, need = (4, licenses.NEAR, licenses.NEED) if t.is_text else (2, 0, 1.0)
        places = {}
        for p in range(len(t.words) - k + 1):
            places.setdefault(tuple(t.words[p:p + k]), []).append(p)
        lines = {}
        for i in range(len(words) - k + 1):
            for p in places.get(tuple(words[i:i + k]), ()):
                lines.setdefault(i - p, set()).add(p)
        groups = []
        for d in sorted(lines):
            if not groups or d - groups[-1][-1] > near:
                groups.append([])
            groups[-1].append(d)
        for g in groups:
            hit = set().union(*(lines[d] for d in g))
            share = len({p + j for p in hit for j in range(k)}) / len(t.words)
            score = max(score, share)
            if share >= need:
                labels.add(t.label)
        if t.base:
            n = len(t.words)
            base += [(i, t.label) for i in range(len(words) - n + 1) if words[i:i + n] == t.words]
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})),
            ",".join(sorted(labels)), score)


def _tuple(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_scan_against_brute_force(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    df = df.withColumns({c: F.lit("mine") for c in ("id", "key", "words", "pair", "four", "at", "hash", "t", "tpos", "gram", "n_words", "labels", "span")})
    got = sorted(((r.doc_id, *_tuple(r)) for r in licenses.scan(df).collect()), key=str)
    assert got == sorted(((i, *_scan(t)) for i, t in TEXTS), key=str)
    labels = {r[0]: r[6] for r in got}
    assert labels[9] == labels[10] == labels[11] == labels[22] == "mit-text" and labels[12] == "" and labels[17] == "cc-by-nc"


def test_spans_of_two_copies_lie_apart(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    found = sorted((r.first, r.last) for r in licenses.license_spans(df).where("doc_id = 10").collect())
    n = len(_words(NOTICE))
    assert found == [(50, 49 + n), (52 + n, 51 + 2 * n)]


def test_empty_table_and_own_templates(spark):
    own = (Template("x", "one two"), Template("y", " ".join(f"w{i}" for i in range(30))))
    df = spark.createDataFrame([(1, "One, two."), (2, " ".join(f"w{i}" for i in range(25))), (3, "one")], "doc_id long, text string")
    assert sorted((r.doc_id, r.labels, r.n_base) for r in licenses.scan(df, own).collect()) == [(1, "x", 0), (2, "y", 0), (3, "", 0)]
    assert licenses.scan(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(df, (Template("short", "one"),))


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = licenses.hits(df, BASE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_op12_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: _tuple(r) for r in queries.op12_licenses(spark, SF).collect()}
    assert got == {r.doc_id: _scan(r.text) for r in table}
    assert any(x[1] for x in got.values())
