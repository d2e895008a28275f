"""Results of operators 7, 9 and 10 worked out again in plain Python."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgermatch.llm import fingerprints, language, quality, textbytes
from ledgermatch.llm.scratch import ship_package

RNG = random.Random(12)
M = (1 << 64) - 1
WORDS = [f"{RNG.choice(['al', 'be', 'Ga', 'dé', 'x'])}{RNG.randint(0, 40)}" for _ in range(60)]
TEXTS = [" ".join(RNG.choice(WORDS) for _ in range(n)) for n in (0, 1, 2, 3, 9, 40, 300, 700)] + ["a a a a a", "Tab\tand\nline", "é" * 9, "1 2, 3. Four!! FIVE (six) sevenEight 99999"]


# ---- 7: the weighted vote ----

def _mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ x >> 31


def _hash(values):
    """Polynomial hash of a row of 64-bit values, as ``textbytes`` defines it for bytes and for words."""
    base, total = textbytes._BASE | 1, 0
    inverse = pow(base, -1, 1 << 64)
    for i, v in enumerate(values):
        total = (total + v * pow(inverse, i, 1 << 64)) & M
    return _mix(total)


def _vote(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    words = [_hash([int(textbytes.TABLE[b]) for b in w]) for w in re.findall(rb"[^\x20\x09-\x0D]+", low)]
    terms = [_hash(pair) for pair in zip(words, words[1:])] if len(words) > 1 else [_mix(w) for w in words]
    votes = defaultdict(Fraction)
    for term, n in Counter(terms).items():
        weight = Fraction(round(4 * (1 + math.log(n))), 4)
        bits = [_mix((term + (0xD6E8FEB86659FD93 * (k + 1) % (1 << 64))) & M) for k in (0, 1)]
        for i in range(128):
            votes[i] += weight if bits[i // 64] >> i % 64 & 1 else -weight
    return tuple(sum(1 << i for i in range(64) if votes[64 * k + i] > 0) for k in (0, 1))


def test_fingerprints_are_the_weighted_vote():
    data, offs = textbytes.byte_arrays(pa.array(TEXTS))
    got = fingerprints.text_fingerprints(data, offs)
    assert [tuple(int(x) for x in row) for row in got] == [_vote(t) for t in TEXTS]
    assert len({tuple(row) for row in got.tolist()}) > 8


@pytest.mark.parametrize("kind", ["even", "sparse", "long texts together", "one id", "nulls and extremes"])
def test_ranges_hold_about_the_same_bytes(spark, kind):
    ship_package(spark)
    n = 4000
    key = {"even": F.col("id"), "sparse": F.col("id") * F.col("id") * F.col("id"), "long texts together": F.col("id"), "one id": F.lit(7).cast("long"),
           "nulls and extremes": F.when(F.col("id") % 2 == 0, F.lit(-(1 << 63)).cast("long")).otherwise(F.lit((1 << 63) - 1).cast("long") - F.col("id"))}[kind]
    size = F.when(F.col("id").between(1000, 1100), 100_000).otherwise(100) if kind == "long texts together" else F.lit(100)
    narrow = spark.range(n).select(key.alias("key"), size.cast("int").alias("bytes"))
    edges = fingerprints.range_edges(narrow, 16)
    rows = [(r.key, r.bytes) for r in narrow.collect()]
    held = Counter()
    for k, b in rows:
        held[int(np.searchsorted(edges, k, "right"))] += b
    if kind == "one id":
        assert len(edges) == 0
    else:
        heaviest = max(sum(b for k, b in rows if k == x) for x in {k for k, _ in rows if k <= 0 or kind != "nulls and extremes"})
        assert max(held.values()) <= 2 * sum(b for _, b in rows) / 16 + heaviest and len(edges) >= 8


# ---- 9: the whole posterior ----

def _slots(text):
    raw = bytes(32 if b in b" \t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [(((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 18 for i in range(len(raw) - 2)]


def _soft(scores):
    best = max(scores)
    powers = [math.exp(x - best) for x in scores]
    return [p / sum(powers) for p in powers]


def _identified(pages, training):
    langs = sorted({x for x, _ in training if x is not None})
    n = len(langs)
    counts = {x: Counter() for x in langs}
    for x, text in training:
        if x is not None:
            counts[x].update(_slots(text))
    total = {x: sum(counts[x].values()) + 0.5 * language.SLOTS for x in langs}
    rows = []
    for host, declared, body in pages:
        slots = _slots(body)
        scale = min(1, language.TEXT_TRIGRAMS / max(len(slots), 1))
        ll = [scale * sum(math.log((counts[x][s] + 0.5) / total[x]) for s in slots) for x in langs]
        parts = host.split(".") if host else None
        rows.append({"ll": ll, "p": _soft(ll), "host": host, "domain": ".".join(reversed(parts[-2:])) if parts else None,
                     "declared": declared if declared in langs else None, "suffix": parts[-1] if parts else None})
    mass = [1 + sum(r["p"][i] for r in rows) for i in range(n)]
    share = [m / sum(mass) for m in mass]
    sums = {key: defaultdict(lambda: [0.0] * n) for key in ("host", "domain", "declared", "suffix")}
    for r in rows:
        for key, by in sums.items():
            if r[key] is not None:
                by[r[key]] = [a + b for a, b in zip(by[r[key]], r["p"])]
    out = []
    for r in rows:
        own = {k: [max(sums[k][r[k]][i] - r["p"][i], 0.0) if r[k] is not None else 0.0 for i in range(n)] for k in ("host", "domain")}
        prior = [(own["domain"][i] + 5 * share[i]) / (sum(own["domain"]) + 5) for i in range(n)]
        prior = [(own["host"][i] + 2 * prior[i]) / (sum(own["host"]) + 2) for i in range(n)]
        scores = [math.log(prior[i]) + r["ll"][i] for i in range(n)]
        for key in ("declared", "suffix"):
            if r[key] is not None:
                s = sums[key][r[key]]
                scores = [scores[i] + math.log((s[i] + 2 * sum(s) / sum(mass)) / (mass[i] + 2)) for i in range(n)]
        post = _soft(scores)
        out.append((langs[post.index(max(post))], max(post), langs[r["p"].index(max(r["p"]))]))
    return out


def test_posteriors_of_pages(spark):
    ship_package(spark)
    words = {"fr": ["le", "chat", "noir", "été"], "en": ["the", "black", "cat", "this"], "de": ["die", "Katze", "über", "schwarz"]}
    say = lambda x, n: " ".join(RNG.choice(words[x]) for _ in range(n))
    training = [(x, say(x, 30)) for x in words for _ in range(5)] + [(None, "none"), ("fr", None), ("en", "")]
    hosts = ["www.a.example.fr", "b.example.fr", "c.de", "d.co.uk", "localhost", None]
    pages = []
    for i in range(60):
        x = RNG.choice(list(words))
        pages.append((RNG.choice(hosts), RNG.choice([x, None, "xx", "en"]), say(x, RNG.choice([0, 1, 3, 40])) if i % 13 else ""))
    html = [(i, f"http://{h}/p{i}" if h else "no address", (f'<html lang="{d}">' if d else "<html>") + b) for i, (h, d, b) in enumerate(pages)]
    found = language.identify(spark.createDataFrame(html, "page_id long, url string, html string"),
                              spark.createDataFrame(training, "lang string, text string")).collect()
    bodies = [(h, d, " " + b) for h, d, b in pages]  # the tag leaves a space
    want = _identified(bodies, training)
    for r in found:
        lang, probability, text_lang = want[r.page_id]
        assert r.probability == pytest.approx(probability, rel=1e-9)
        assert r.lang == lang and r.text_lang == text_lang
    assert len({r.lang for r in found}) == 3


OLD = [(r"(?is)<(script|style)\b[^<>]*+>.*?</\1\s*+>|<!--.*?-->", " "), (r"<[^<>]*+>", " ")]


def test_visible_text_is_what_it_was_and_linear(spark):
    """Open comments and scripts hide nothing but their tag, as before, without a try that reads to the end for each."""
    import time
    bits = ["<script>", "</script >", "<STYLE a>", "</style>", "<!--", "-->", "<p>", "text ", "<", ">", "-", "\n", "<script", "</script", "<!-- x >"]
    cases = ["".join(RNG.choice(bits) for _ in range(RNG.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    old = F.col("h")
    for pattern, by in OLD:
        old = F.regexp_replace(old, pattern, by)
    bad = df.select("h", language.visible_text(F.col("h")).alias("new"), old.alias("old")).where("new != old").collect()
    assert not bad
    for open_tag in ("<!--", "<script>", "<style x>", "</script", "<", "<!-- -->x<!--", "<script></script><script>"):
        begin = time.perf_counter()
        n = spark.createDataFrame([(open_tag * (1_000_000 // len(open_tag)),)], "h string").select(F.length(language.visible_text(F.col("h")))).first()[0]
        assert n >= 0 and time.perf_counter() - begin < 10


# ---- 10: vectors, pooling and the network ----

def _slow_tokens(text):
    raw, out = text.encode(), []
    kind = lambda b: int(quality._CLASS[b])
    i = 0
    while i < len(raw):
        j = i + 1
        while j < len(raw) and kind(raw[j]) == kind(raw[i]):
            j += 1
        if kind(raw[i]):
            token = raw[i:j]
            low = bytes(b + 32 if 65 <= b <= 90 else b for b in token)
            h = _hash([int(textbytes.TABLE[b]) for b in low])
            up, small = sum(65 <= b <= 90 for b in token), sum(97 <= b <= 122 for b in token)
            size, again = min(len(token), 15), int(bool(out) and out[-1][2] == h)
            case = 0 if not up else 1 if small else 2 if up > 1 else 3
            shape = (case * 8 + size // 2 + 32 * again if kind(raw[i]) == 1 else 64 + size + 16 * again if kind(raw[i]) == 2
                     else 96 + (raw[i] * 3 + min(size, 3)) % 160)
            out.append((h >> 50, shape, h))
        i = j
    return out


def test_vectors_pooling_and_scores(spark):
    ship_package(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(50, None)], "doc_id long, text string")
    sums = np.zeros((quality.WORD_SLOTS + quality.SHAPE_SLOTS, quality.DIM))
    index = np.zeros_like(sums)
    for slot in range(len(index)):
        for places, signs in zip(quality._PLACES, quality._SIGNS, strict=True):
            index[slot, places[slot]] += signs[slot]
    for t in TEXTS:
        toks = _slow_tokens(t)
        for ids in ([w for w, _, _ in toks], [quality.WORD_SLOTS + s for _, s, _ in toks]):
            for i, a in enumerate(ids):
                for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                    if j != i:
                        sums[a] += index[ids[j]]
    want = np.sign(sums) * np.log1p(np.abs(sums))
    for part in (slice(0, quality.WORD_SLOTS), slice(quality.WORD_SLOTS, None)):
        some = np.abs(want[part]).sum(axis=1) > 0
        want[part][some] -= want[part][some].mean(axis=0)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-300)
    vectors = quality.word_vectors(df)
    assert np.abs(vectors - want).max() < 1e-6
    rng = np.random.RandomState(0)
    model = quality.Model(vectors, rng.randn(64), 1 + rng.rand(64), rng.randn(64, quality.HIDDEN), rng.randn(quality.HIDDEN), rng.randn(quality.HIDDEN), 0.3, 1.7)
    got = {r.doc_id: r.score for r in quality.scores(df, model).collect()}
    for i, t in [*enumerate(TEXTS), (50, "")]:
        toks = _slow_tokens(t)
        x = [sum(vectors[w][d].astype(float) for w, _, _ in toks) / max(len(toks), 1) for d in range(quality.DIM)]
        x += [sum(vectors[quality.WORD_SLOTS + s][d].astype(float) for _, s, _ in toks) / max(len(toks), 1) for d in range(quality.DIM)]
        hidden = [math.tanh(sum((x[d] - model.mean[d]) / model.scale[d] * model.w1[d, k] for d in range(64)) + model.b1[k]) for k in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, model.w2)) + model.b2
        assert got[i] == pytest.approx(1 / (1 + math.exp(-min(max(logit / 1.7, -30), 30))), rel=1e-6, abs=1e-12)


def test_the_same_row_of_an_id_is_learnt_from(spark):
    ship_package(spark)
    rows = [(i % 40, t) for i, t in enumerate(TEXTS * 12)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    models = []
    for order in (rows, rows[::-1]):
        models.append(quality.fit(spark.createDataFrame(order, "doc_id long, text string").repartition(3), labels))
    assert np.allclose(models[0].w1, models[1].w1, atol=1e-9)
