"""The corpus pipeline against a version without Spark, stage by stage, on the smallest tables."""

import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from ledgermatch.llm import mixing, pii, quality, textbytes  # noqa: E402
from ledgermatch.llm.scratch import ship_package, written  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, written and read again as the runner does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        kept = written(stage(spark, docs, SF), f"test-{i}")
        out.append((docs, kept))
        docs = kept
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    columns = stages[0][0].columns
    assert [kept.columns for _, kept in stages] == [columns] * 4 + [[*columns, "copy"]]


def test_quality_stage(spark, stages):
    ship_package(spark)
    docs, kept = stages[0]
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = set()
    for i, r in _rows(docs).items():
        data, offs = textbytes.byte_arrays(pa.array([r.text]))
        words, shapes, _ = quality.tokens(data, offs)
        x = np.concatenate([model.vectors[words].mean(axis=0), model.vectors[quality.WORD_SLOTS + shapes].mean(axis=0)]) if len(words) else np.zeros(2 * quality.DIM)
        if model.scores(x[None, :].astype(float))[0] >= 0.3:
            good.add(i)
    assert set(_rows(kept)) == good
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in good for i in clean) >= 0.97 * len(clean)
    assert sum(i not in good for i, q in labels.items() if q == 0) >= 0.8 * sum(q == 0 for q in labels.values())


def test_near_duplicate_stage(stages):
    docs, kept = stages[1]
    rows = sorted(_rows(docs).items())
    fps = [brute.fingerprint(r.text) for _, r in rows]
    roots = brute.components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert set(_rows(kept)) == {rows[r][0] for r in roots}


def test_decontamination_stage(spark, stages):
    docs, kept = stages[2]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = _rows(docs), _rows(kept)
    gone = set(before) - set(after)
    assert {i for i, r in before.items() if any(u in r.text for u in items)} <= gone
    # those that went hold an item: the tokens before and after do not matter
    assert all(any(brute.tiling(before[i].text[:3000], u) >= 0.8 or u in before[i].text for u in items) for i in gone)
    assert gone


def test_masking_stage(stages):
    docs, kept = stages[3]
    before, after = _rows(docs), _rows(kept)
    assert set(before) == set(after)
    masks = Counter()
    for i, r in before.items():
        spans = []
        for s in brute.base_spans(r.text):
            kind, a, b = s.split(":")
            if spans and int(a) < spans[-1][2]:
                spans[-1][2] = max(spans[-1][2], int(b))
            else:
                spans.append([kind, int(a), int(b)])
        text = r.text
        for kind, a, b in reversed(spans):
            text = text[:a] + f"<{kind}>" + text[b:]
            masks[kind] += 1
        if not re.search(r"<(iban|ssn)>", after[i].text):
            assert after[i].text == text and after[i].n_chars == len(text)
    assert masks


def test_mixing_stage(stages):
    docs, kept = stages[4]
    copies = Counter(r.doc_id for r in kept.collect())
    before = _rows(docs)
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    sizes = brute.by_source([(r.source, len(brute.words(r.text))) for r in before.values()])
    targets = brute.mix_targets(sizes)
    taken = brute.by_source([(before[i].source, n * len(brute.words(before[i].text))) for i, n in copies.items()])
    assert sum(taken.values()) == pytest.approx(sum(targets.values()), rel=0.05)
    plan = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect()}
    assert {i: n for i, n in plan.items() if n} == dict(copies)


def test_run_is_all_stages(spark, stages):
    got = sorted((r.doc_id, r.copy, r.text) for r in cp.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.copy, r.text) for r in stages[-1][1].collect())
    assert pii.BASE_KINDS == ("email", "ip", "card", "phone")
