"""Account numbers with text behind them, and social security numbers with one context word."""

import random

from ledgermatch.llm import pii

RNG = random.Random(3)


def _account(country, n):
    """A valid account number of n characters; the check digits leave 1 modulo 97."""
    rest = "".join(RNG.choice("0123456789") for _ in range(n - 4))
    value = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{country}{98 - value % 97:02d}{rest}"


def _spaced(account):
    return " ".join(account[i:i + 4] for i in range(0, len(account), 4))


def _spans(spark, texts, kind):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(x.start, x.end) for x in r.pii if x.kind == kind] for r in pii.find_spans(df).collect()}


def test_account_numbers_end_where_their_country_says(spark):
    cases = [("", "ES91 2100 0418 4502 0005 1332", " BIC CAIXESBB"), ("", "BE68539007547034", " BIC"), ("", "BE68539007547034", "."),
             ("", "AT611904300234573201", " 2024"), ("IBAN ", "GB82 WEST 1234 5698 7654 32", " A1"), ("BIC AB12 ", "ES91 2100 0418 4502 0005 1332", ""),
             ("ü ", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", " EUR"), ("", _account("ZZ", 24), ", ")]
    for n, codes in pii.IBAN_LENGTHS.items():
        for country in codes.split():
            account = _account(country, n)
            cases += [("to ", account, " 2024 EUR"), ("", _spaced(account), " BIC AB"), ("", _spaced(account), " " + _spaced(account))]
    got = _spans(spark, ["".join(c) for c in cases], "iban")
    for i, (before, account, after) in enumerate(cases):
        begin, n = len(before), len(account)
        want = [(begin, begin + n), (n + 1, 2 * n + 1)] if after == " " + account else [(begin, begin + n)]
        assert got[i] == want, cases[i]


def test_wrong_account_numbers_are_dropped(spark):
    texts = ["ES91 2100 0418 4502 0005 1333 BIC", "BE6853900754703 BIC", "AT611904300234573202 2024", "xBE68539007547034", "BE68539007547034x"]
    assert _spans(spark, texts, "iban") == {i: [] for i in range(len(texts))}


def test_one_context_word_confirms_a_social_security_number(spark):
    texts = ["SSN: 123-45-6789", "123-45-6789 (my ssn)", "123-45-6789", "part no. 123-45-6789", "SSN: 123-45-67890", "SSN" + " " * 40 + "123-45-6789"]
    assert _spans(spark, texts, "ssn") == {0: [(5, 16)], 1: [(0, 11)], 2: [], 3: [], 4: [], 5: []}
    masked = pii.redact(spark.createDataFrame([(t,) for t in [texts[0], "BE68539007547034 BIC"]], "text string"))
    assert [r.text for r in masked.collect()] == ["SSN: <ssn>", "<iban> BIC"]
