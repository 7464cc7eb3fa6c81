import random
import re

from shelfweek.llm import pii, text_spans
from tests.llm import brute
from pyspark.sql import functions as F


def made():
    rng = random.Random(4)
    parts = ["a@b.com", "_x@y.org", "@", ".", " ", "-", "+", "1.2.3.4", "255.256.1.1", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (517) 555-5141", "+12345678901234567", "é𝒳", "9", "a", "0000", ")", "(", ",", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    long = "1.1.1.1 " * 800 + "a@b.c," * 3000 + "9" * 5000 + "+" * 300 + "a" * 3000
    return [*texts, "", None, long, "4" * 16, "0" * 14]


def test_base_spans_equal_brute_force(spark):
    texts = made()
    rows = [(t, k if k % 9 else None, 1, "z", "w") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, spans int, _text string, email string")
    found = pii.report(docs).collect()
    assert len(found) == len(rows)
    want = sorted(brute.sha(brute.pii(t)) for t in texts)
    assert sorted(r.base_sha256 for r in found) == want
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for k, t in enumerate(texts):
        if k % 9:
            listed = brute.pii(t)
            base = [s for s in by_id[k].spans.split(",") if s.split(":")[0] in pii.BASE]
            assert ",".join(base) == listed
            counts = [sum(s.startswith(f"{kind}:") for s in listed.split(",")) for kind in pii.BASE]
            assert [by_id[k][f"n_{kind}"] for kind in pii.BASE] == counts


def test_added_kinds_need_their_check_or_a_word_nearby(spark):
    texts = {
        1: "account DE89 3704 0044 0532 0130 00.",
        2: "account DE88 3704 0044 0532 0130 00.",
        3: "her ssn is 078-05-1120 they say",
        4: "part 078-05-1120 they say",
        5: "DE89370400440532013000",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert found == {1: "iban:8:35", 2: "", 3: "id:11:22", 4: "", 5: "iban:0:22"}
    score = {r.doc_id: r.spans[0].score for r in pii.find(docs).where("size(spans) > 0").collect()}
    assert score[1] > score[5]


def test_account_numbers_end_at_their_countrys_length(spark):
    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0

    def number(country, body):
        spelled = "".join(str(int(c, 36)) for c in f"{body}{country}00")
        return f"{country}{98 - int(spelled) % 97:02}{body}"

    unlisted = number("ZZ", "37040044053201300")
    passing = next(n for n in (number("BE", f"{k:012}") for k in range(1000)) if luhn(n[2:]))
    texts = {
        1: "DE89370400440532013000 Please",
        2: "pay DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX now",
        3: "GB29 NWBK 6016 1331 9268 19 DE89370400440532013000 12 AB",
        4: f"to {unlisted} Please",
        5: f"to {passing}.",
        6: "code AB12 DE89 3704 0044 0532 0130 00",
        7: "DE89 3704 0044 0532 0130 0012",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    ibans = {i: [texts[i][s.start : s.end] for s in r.spans if s.kind == "iban"] for i, r in found.items()}
    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    assert ibans == {
        1: [plain], 2: [spaced], 3: ["GB29 NWBK 6016 1331 9268 19", plain], 4: [unlisted], 5: [passing], 6: [spaced], 7: [],
    }
    assert [s.kind for s in found[5].spans] == ["iban", "card"]


def test_words_nearby_reach_across_other_matches(spark):
    gap = "x" * 38
    texts = {
        1: "SSN 078-05-1120, 219-09-9999",
        2: "219-09-9999, 078-05-1120 is her ssn",
        3: f"SSN 078-05-1120 {gap} 219-09-9999 {gap} 219-09-9999",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert found == {1: "id:4:15,id:17:28", 2: "id:0:11,id:13:24", 3: "id:4:15"}


def test_native_and_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.report(docs).collect() == []
    plan = pii.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_running_sums_over_blocks(spark):
    n = 1300
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).cast("array<long>").alias("v"))
    (row,) = df.select(text_spans.running_sums(F.col("v")).alias("s")).collect()
    assert row.s == [k * (k + 1) // 2 for k in range(1, n + 1)]
    none = spark.range(1).select(F.array().cast("array<long>").alias("v"))
    assert none.select(text_spans.running_sums(F.col("v")).alias("s")).first().s == []
