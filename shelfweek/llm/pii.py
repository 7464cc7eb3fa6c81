"""Personal data: patterns propose spans, checksums confirm them, words nearby weigh in.

Built-in functions only; a row never leaves its task. Four base kinds (email, ip, card,
phone) stand on their pattern and check alone. Two more kinds need a score of THRESHOLD:
account numbers (iban), confirmed by their remainder by 97, and nine-digit identity numbers
(id), which have no checksum and so need a telling word nearby.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text_spans

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "id")
THRESHOLD = 0.6
#: Characters before a span, and after it, in which words count as nearby.
NEARBY = 40
#: Account numbers of a country have one length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """By the country's length first, so that the next word is not taken. Otherwise in one
    piece, in groups of four with a short last one, or up to any word's end, but not into a
    number of a listed country."""

    def either(names):
        return "|".join(names.split())

    begin = rf"(?<![A-Za-z0-9])(?:{either(' '.join(IBAN_LENGTHS.values()))})[0-9]{{2}}\x20?[A-Z0-9]"
    more = rf"(?!{begin})[A-Z0-9]"
    bodies = [rf"(?:{either(names)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items()]
    bodies += [
        r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
        rf"[A-Z]{{2}}[0-9]{{2}}(?:\x20{more}[A-Z0-9]{{3}}){{2,7}}\x20{more}[A-Z0-9]{{0,2}}",
        rf"[A-Z]{{2}}[0-9]{{2}}(?:\x20?{more}){{11,30}}",
    ]
    return "(?<![A-Za-z0-9])(?:" + "|".join(f"{b}(?![A-Za-z0-9])" for b in bodies) + ")"


# In each pattern a match begins where a run of its first characters begins, or where the
# last match ended (\G): from any later place in the run the rest reads the same, and there
# is no second try. That keeps the search linear on long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban_pattern(),
    "id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
# which texts are searched at all
_NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
    "id": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
}
#: Score of a confirmed span, and what a telling word nearby adds.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.8, "id": 0.3}
WORDS = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "id": "ssn|social|security|identity|taxpayer",
}
BONUS = 0.4


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _remainder_97(match: Column) -> Column:
    """Of the number an account's letters and digits spell, its first four moved last."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc, c):
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        fits = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})$"
        return F.forall(F.split(match, r"\."), lambda part: part.rlike(fits))
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _remainder_97(match) == 1
    return F.lit(True)


def _around(between: Column, found: Column, cut) -> Column:
    """Each stretch with the match after it, cut to NEARBY characters."""
    around = F.zip_with(between, found, lambda b, m: cut(F.concat(b, F.coalesce(m, F.lit(""))), F.lit(NEARBY)))
    return F.when(F.size(found) > 0, around)


def _spans(kind: str, between: Column, found: Column, ends: Column, tails: Column, heads: Column) -> Column:
    numbered = F.zip_with(
        F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1))),
        F.arrays_zip(found.alias("match"), ends.alias("end")),
        lambda k, m: F.struct(k.alias("k"), m["match"].alias("match"), m["end"].alias("end")),
    )
    # with no match the sequence still has one entry
    real = F.filter(
        numbered, lambda m: F.coalesce(F.length(m["match"]) > 0, F.lit(False)) & _confirmed(kind, m["match"])
    )

    def span(m):
        # across other matches; they have two characters at least
        count = F.least(m["k"] - 1, F.lit(NEARBY // 2))
        before = F.concat(
            F.array_join(F.slice(tails, m["k"] - count, count), ""),
            F.right(F.get(between, m["k"] - 1), F.lit(NEARBY)),
        )
        near = F.concat(
            F.right(before, F.lit(NEARBY)),
            F.lit(" "),
            F.left(F.array_join(F.slice(heads, m["k"] + 1, F.lit(NEARBY // 2)), ""), F.lit(NEARBY)),
        )
        told = F.lower(near).rlike(rf"(?<![a-z])(?:{WORDS[kind]})")
        score = F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(told, F.lit(BONUS)).otherwise(F.lit(0.0)))
        return F.struct(
            (m["end"] - F.length(m["match"])).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            score.alias("score"),
        )

    return F.transform(real, span)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans) per row: array of (start, rank, end, kind, score) by start, then by
    kind as in KINDS; code points, end exclusive.

    Matches of a kind are leftmost and do not overlap one another; one that fails its check
    is dropped and not tried again from inside. Base spans always stay, whatever their
    score; an added one stays with a score of THRESHOLD if it overlaps no base span, an
    account number also beside a card, whose check its digits may pass. Null text counts as empty. Rows with equal or null ids stay rows of their own. Other columns
    are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    )
    # each step is a column of its own, so that no search runs twice
    searched = {k: text_spans.matches(F.col("_text"), p, _NEEDS[k](F.col("_text"))) for k, p in PATTERNS.items()}
    rows = rows.select(
        "_id",
        *[b.alias(f"{k}_between") for k, (b, _) in searched.items()],
        *[f.alias(f"{k}_found") for k, (_, f) in searched.items()],
    )
    rows = rows.select(
        "*", *[text_spans.steps(F.col(f"{k}_between"), F.col(f"{k}_found")).alias(f"{k}_steps") for k in KINDS]
    )
    rows = rows.select(
        "*",
        *[text_spans.running_sums(F.col(f"{k}_steps")).alias(f"{k}_ends") for k in KINDS],
        *[_around(F.col(f"{k}_between"), F.col(f"{k}_found"), F.right).alias(f"{k}_tails") for k in KINDS],
        *[_around(F.col(f"{k}_between"), F.col(f"{k}_found"), F.left).alias(f"{k}_heads") for k in KINDS],
    )
    parts = ("between", "found", "ends", "tails", "heads")
    rows = rows.select("_id", *[_spans(k, *[F.col(f"{k}_{p}") for p in parts]).alias(k) for k in KINDS])
    rows = rows.select(
        "_id",
        F.flatten(F.array(*[F.col(k) for k in BASE])).alias("base"),
        F.flatten(F.array(*[F.col(k) for k in KINDS[len(BASE) :]])).alias("added"),
    )

    card, iban = KINDS.index("card"), KINDS.index("iban")

    def clear(s):
        return (s["score"] >= THRESHOLD) & ~F.exists(
            "base",
            lambda b: (b["start"] < s["end"])
            & (s["start"] < b["end"])
            & ~((s["rank"] == iban) & (b["rank"] == card)),
        )

    spans = F.array_sort(F.concat("base", F.filter("added", clear)))
    return rows.select(F.col("_id").alias(id_col), spans.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(rank):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return found.select(
        id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
