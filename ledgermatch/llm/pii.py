"""Personal data: patterns propose spans, checksums confirm them, context adjusts a score.

For each kind a regular expression proposes leftmost, non-overlapping matches
over the whole text. A validator then drops what fails: address parts at most
255, 14 to 19 digits with a Luhn sum for cards, 10 to 15 digits for phones, a
mod-97 remainder of 1 for account numbers (IBAN). Dropped matches are not tried
again at another place. An account number is as long as its country's are, so
that a word or number after it is no part of it; for a country code that is not
in ``IBAN_LENGTHS`` it is the longest match before the next listed one. A span's score starts from what its kind's checks are
worth and rises with each context word of its kind in the ``CONTEXT_CHARS``
characters on either side. The base kinds (email, ip, card, phone) stay
whatever their score; the added kinds (iban, and ssn: bare groups of digits
that no checksum confirms, but one context word does) need ``THRESHOLD``.

All of it is built-in column functions. ``split`` and ``regexp_extract_all``
take a text apart into gaps and matches, whose running lengths are the
positions (code points, end exclusive). Two rewrites keep the patterns linear in
the length of the text without a change of what they match: repetitions are
possessive wherever what follows cannot match their last character, and a
pattern that begins with a repeated class is only tried where that class does
not hold for the character before, or where the last match ended.

Defined results: a null or empty text has no spans; long texts are read whole;
spans of different kinds may overlap, and are ordered by start, then by kind
as listed; equal rows give equal results, rows are never joined or grouped;
other columns, whatever their names, are ignored by ``find_spans`` and kept by
``redact``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
THRESHOLD = 0.6
#: Lengths are summed up in runs of this many matches, so that the work does not grow with their square.
RUN = 256
#: Code points of the pieces from which contexts and kept text are cut.
CHUNK = 256


#: Characters of an account number by country: the ISO 13616 registry and the codes in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """Groups of four, spaced or not; of the listed countries as many as their length asks for."""
    listed = "|".join(
        rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, codes in IBAN_LENGTHS.items())
    listed = rf"(?<![A-Za-z0-9])(?:{listed})(?![A-Za-z0-9])"
    codes = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = (rf"(?<![A-Za-z0-9])(?!{codes})[A-Z]{{2}}[0-9]{{2}}(?:\x20?(?!{listed})[A-Z0-9]{{4}}){{2,7}}"
             rf"(?:\x20?(?!{listed})[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])")
    return rf"(?:{listed}|{other})"


@dataclass(frozen=True)
class Kind:
    name: str
    #: What ``find`` proposes, in Java's syntax.
    pattern: str
    #: A cheap test without which a text has no match.
    hint: str
    #: Score of a match that passes its validator.
    base: float
    context: str
    always: bool


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"@[A-Za-z0-9-]+\.", 0.9, r"(?i)\b(e-?mail|mail|contact|write|address)\b", True),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
         r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", 0.7, r"(?i)\b(ip|host|server|address|login|ssh)\b", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         r"[0-9](?:[\x20-]?[0-9]){13}", 0.8, r"(?i)\b(card|visa|credit|debit|payment|pay)\b", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9][\x20().0-9-]", 0.7, r"(?i)\b(phone|tel|call|mobile|fax)\b", True),
    Kind("iban", _iban_pattern(),
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", 0.8, r"(?i)\b(iban|account|bank|transfer|konto|compte)\b", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.5, r"(?i)\b(ssn|social|security|insurance)\b", False),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.always)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is divisible by ten."""
    doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number in capitals has the remainder 1: country and check digits last, letters as 10 to 35."""
    compact = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    step = lambda a, c: F.when(F.ascii(c) >= 65, (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97)
    return (F.length(compact).between(15, 34)) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.when(F.length(_digits(match)).between(14, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _with_running(df: DataFrame, values: str, out: str, combine: Callable[[Column], Column] = _sum) -> DataFrame:
    """``combine`` of the elements of the array ``values`` before each element, in runs of RUN.

    Each step is a column of its own: an expression inside a lambda would be worked out again for every element.
    """
    n_runs = F.greatest(F.ceil(F.size(values) / RUN), F.lit(1)).cast("int")
    df = df.withColumn("__runs", F.transform(F.sequence(F.lit(0), n_runs - 1), lambda r: F.slice(values, r * RUN + 1, F.lit(RUN))))
    df = df.withColumn("__sums", F.transform("__runs", combine))
    df = df.withColumn("__starts", F.transform("__sums", lambda x, r: combine(F.slice("__sums", F.lit(1), r))))
    return df.withColumn(out, F.flatten(F.zip_with("__runs", "__starts", lambda run, start: F.transform(
        run, lambda x, i: combine(F.array(start, combine(F.slice(run, F.lit(1), i)))))))).drop("__runs", "__sums", "__starts")


def _most(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: F.greatest(s, x))


def _chunked(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__chunks``: the text in pieces of CHUNK code points, in which a place is found without a walk from the start."""
    return df.withColumn("__chunks", F.when(_any_hint(text), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
                         .otherwise(F.array().cast("array<string>")))


def _any_hint(text: str) -> Column:
    return F.col(text).rlike("|".join(f"(?:{k.hint})" for k in KINDS))


def _cut(begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` (exclusive) of the chunks."""
    first = F.floor(begin / CHUNK).cast("int")
    n = F.floor((end - 1) / CHUNK).cast("int") - first + 1
    return F.when(end > begin, F.substring(F.array_join(F.slice("__chunks", first + 1, n), ""), begin - first * CHUNK + 1, end - begin)).otherwise("")


def _with_spans(df: DataFrame, text: str, kind: Kind) -> DataFrame:
    """Adds ``__<kind>``: array of (start, end, match, score), in order."""
    k = f"__{kind.name}"
    has = F.col(text).rlike(kind.hint)
    none_s, none_i = F.array().cast("array<string>"), F.array().cast("array<int>")
    df = df.withColumn(f"{k}_m", F.when(has, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none_s))
    some = F.size(f"{k}_m") > 0
    # gap and match lengths before a match make its start
    df = df.withColumn(f"{k}_g", F.when(some, F.transform(F.split(text, kind.pattern, -1), F.length)).otherwise(none_i))
    df = df.withColumn(f"{k}_l", F.when(some, F.zip_with(
        F.slice(f"{k}_g", F.lit(1), F.size(f"{k}_m")), f"{k}_m", lambda g, m: g + F.length(m))).otherwise(none_i))
    df = _with_running(df, f"{k}_l", f"{k}_b")
    df = df.withColumn(f"{k}_s", F.when(some, F.zip_with(f"{k}_b", f"{k}_g", lambda a, g: a + g)).otherwise(none_i))
    # zip_with goes by the longer array; the last gap has no match
    found = F.transform(F.filter(F.arrays_zip(F.col(f"{k}_s").alias("start"), F.col(f"{k}_m").alias("match")),
                                 lambda x: F.when(x["match"].isNotNull(), _valid(kind.name, x["match"])).otherwise(False)),
                        lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"),
                                           x["match"].alias("match")))
    df = df.withColumn(f"{k}_f", F.when(some, found).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>")))
    # a context word may stand at the text's very end: the last chunk is shorter, and slices end there
    around = lambda x: F.concat(
        _cut(F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)), x["start"]), F.lit(" "), _cut(x["end"], x["end"] + CONTEXT_CHARS))
    scored = F.transform(f"{k}_f", lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(kind.name).alias("kind"),
        F.lit(KINDS.index(kind)).alias("order"),
        F.least(F.lit(1.0), F.lit(kind.base) + 0.1 * F.least(F.lit(3), F.size(F.regexp_extract_all(
            around(x), F.lit(kind.context), F.lit(0))))).alias("score")))
    kept = scored if kind.always else F.filter(scored, lambda x: x["score"] >= THRESHOLD)
    shape = "array<struct<start:int,end:int,kind:string,order:int,score:double>>"
    return df.withColumn(k, F.when(F.size(f"{k}_f") > 0, kept).otherwise(F.array().cast(shape)).cast(shape)).drop(
        *[f"{k}_{x}" for x in "mglbsf"])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, text and ``pii``: array of (start, end, kind, order, score) in order of start, then kind."""
    df = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    df = _spans(df, "__text")
    return df.select(F.col("__id").alias(id_col), F.col("__text").alias(text_col), F.col("__pii").alias("pii"))


def _spans(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__chunks`` and ``__pii`` to a frame of columns that are all this module's own."""
    df = _chunked(df, text)
    for kind in KINDS:
        df = _with_spans(df, text, kind)
    names = [f"__{k.name}" for k in KINDS]
    by_place = F.transform(F.concat(*names), lambda x: F.struct(x["start"], x["order"], x["end"], x["kind"], x["score"]))
    ordered = F.transform(F.array_sort(by_place), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["order"].alias("order"), x["score"].alias("score")))
    return df.withColumn("__pii", ordered).drop(*names)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<{}>") -> DataFrame:
    """All columns, spans in the text replaced by their kind's mask; overlapping spans become one, named by the first.

    A span begins a new cut where no span before it reaches beyond its start. The kept pieces are put together from
    the chunks between the cuts, so the work grows with the text and the spans, not with their product.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    df = _spans(df, "__text")
    df = df.withColumn("__ends", F.transform("__pii", lambda x: x["end"]))
    df = _with_running(df, "__ends", "__reach", _most)
    # where the cuts begin among the spans, and how far all spans before that reach
    df = df.withColumn("__first", F.filter(F.transform("__pii", lambda x, i: F.when(x["start"] >= F.element_at("__reach", i + 1), i).otherwise(-1)),
                                           lambda i: i >= 0))
    df = df.withColumn("__all", _most(F.col("__ends")))
    df = df.withColumn("__stop", F.transform("__first", lambda i, j: F.when(
        j + 1 < F.size("__first"), F.element_at("__reach", F.coalesce(F.get("__first", j + 1), F.lit(0)) + 1)).otherwise(F.col("__all"))))
    df = df.withColumn("__cuts", F.zip_with("__first", "__stop", lambda i, stop: F.struct(
        F.get("__pii", i)["start"].alias("start"), stop.alias("end"), F.get("__pii", i)["kind"].alias("kind"))))
    pieces = F.transform("__cuts", lambda x, j: F.concat(
        _cut(F.when(j == 0, 0).otherwise(F.get("__stop", j - 1)), x["start"]), F.format_string(mask.replace("{}", "%s"), x["kind"])))
    clean = F.concat(F.array_join(pieces, ""), _cut(F.col("__all"), F.length("__text")))
    df = df.withColumn("__clean", F.when(F.size("__pii") > 0, clean))
    given = {c: F.col("__row").getField(c) for c in docs.columns}
    return df.select(*[(F.coalesce("__clean", value) if c == text_col else value).alias(c) for c, value in given.items()])
