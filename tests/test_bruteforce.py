"""Random small ledgers against a nested-loop reference written in plain Python.

Keys, amounts and ids come from tiny domains with nulls and duplicates, so
many-to-many keys, null keys, null amounts and repeated ids all occur.
"""

import datetime as dt
import random
from collections import Counter

import pytest

from ledgermatch.operators import mart, staging
from ledgermatch.operators.reconcile import MatchSpec, reconcile

SEEDS = [1, 2, 3, 4, 5, 6]
DAY = dt.date(2024, 1, 1)


def _ledgers(seed):
    rnd = random.Random(seed)

    def row(prefix):
        return (rnd.choice([f"{prefix}{i}" for i in range(4)] + [None]),
                rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]),
                rnd.choice([1.0, 1.03, 1.06, 2.0, None]),
                (DAY + dt.timedelta(days=rnd.choice([0, 1]))).isoformat())
    return [row("I") for _ in range(rnd.randint(0, 10))], [row("E") for _ in range(rnd.randint(0, 10))]


def _within(a, b, tol):
    return a is not None and b is not None and abs(a - b) <= tol


def _brute_match(left, right, tol):
    """Full outer match on (cust, loc), null-safe, with an optional amount condition."""
    def ok(l, r):
        return l[1] == r[1] and l[2] == r[2] and (tol is None or _within(l[3], r[3], tol))
    out = Counter()
    for l in left:
        partners = [r for r in right if ok(l, r)]
        for r in partners:
            out[(l[0], r[0], "both")] += 1
        if not partners:
            out[(l[0], None, "left_only")] += 1
    for r in right:
        if not any(ok(l, r) for l in left):
            out[(None, r[0], "right_only")] += 1
    return out


def _brute_mart(left, right, tol=0.05):
    """Inner join with SQL equality, then the transaction-id rule for unmatched rows."""
    def eq(a, b):
        return a is not None and b is not None and a == b
    pairs = [(s, b) for s in left for b in right if eq(s[1], b[1]) and eq(s[2], b[2]) and eq(s[4], b[4])]
    out = Counter()
    for s, b in pairs:
        out[(s[0], b[0], "MATCHED" if _within(s[3], b[3], tol) else "AMOUNT_VARIANCE")] += 1
    paired_i = {s[0] for s, _ in pairs if s[0] is not None}
    paired_e = {b[0] for _, b in pairs if b[0] is not None}
    for s in left:
        if s[0] is None or s[0] not in paired_i:
            out[(s[0], None, "UNMATCHED_INTERNAL")] += 1
    for b in right:
        if b[0] is None or b[0] not in paired_e:
            out[(None, b[0], "UNMATCHED_EXTERNAL")] += 1
    return out


@pytest.mark.parametrize("seed", SEEDS)
def test_matcher_against_nested_loops(spark, seed):
    left, right = _ledgers(seed)
    li = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in left],
                               "internal_tx_id string, customer_id string, location_id string, amount double")
    le = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in right],
                               "external_tx_id string, customer_id string, location_id string, net_amount double")
    for tol, mode in ((None, "filter"), (0.05, "classify")):
        spec = MatchSpec(("customer_id", "location_id"), amount_tolerance=tol or 0.0, mode=mode)
        got = Counter((r["internal_tx_id"], r["external_tx_id"], r["_merge"])
                      for r in reconcile(li, le, spec).classified.collect())
        assert got == _brute_match(left, right, tol), (seed, mode)


@pytest.mark.parametrize("seed", SEEDS)
def test_mart_against_nested_loops(spark, seed):
    left, right = _ledgers(seed)
    raw_i = spark.createDataFrame([(r[0], r[4], r[1], r[2], r[3], 0.0) for r in left],
                                  "transaction_id string, date string, customer_id string, location_id string, "
                                  "amount double, fee double")
    raw_e = spark.createDataFrame([(r[0], r[4], r[1], r[2], r[3]) for r in right],
                                  "transaction_id string, date string, customer_id string, location_id string, "
                                  "amount double")
    fact = mart.fct_reconciled(staging.stage_internal(raw_i), staging.stage_external(raw_e))
    got = Counter((r["internal_transaction_id"], r["external_transaction_id"], r["match_status"])
                  for r in fact.collect())
    assert got == _brute_mart(left, right), seed
