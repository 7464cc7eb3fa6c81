import random

import duckdb
import pytest

from shelfweek.llm import line_dedup
from shelfweek.llm.oracle import ORACLE


def made(seed):
    rng = random.Random(seed)
    sentence = lambda: " ".join(rng.choice(["The", "cat", "of", "é", "a.b", "sat", "dog", "runs"]) for _ in range(rng.choice([1, 3, 5, 8, 9, 20, 30])))
    pool = [sentence() + rng.choice([".", "!", "?!", ""]) for _ in range(25)]
    docs = []
    for k in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            own = [rng.choice(pool) if rng.random() < 0.5 else sentence() + "." for _ in range(rng.randint(0, 4))]
            lines.append(rng.choice([" ", "  "]).join(own))
        docs.append((k, "\n".join(lines)))
    docs += [(70 + k, docs[k][1].replace(" ", "\n", 3 * k).upper() + f"{k}漢字かな" * 9) for k in range(9)]
    return [*docs, (60, None), (61, ""), (62, "\n\n"), (63, " \t"), (64, "x" * 500), (65, f"y {'x' * 500}")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_sql(spark, seed):
    docs = made(seed)
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in docs], "text string, doc_id long, start int, spans string")
    found = {}
    for r in line_dedup.dedup(df).collect():
        spans = ",".join(f"{s.start}:{s.end}:{s.first}" for s in r.spans)
        found[r.doc_id] = (r.n_removed, r.removed_chars, spans, r.text)
        text = dict(docs)[r.doc_id]
        if text is not None:
            left, at = "", 0
            for s in r.spans:
                assert s.start >= at
                left, at = left + text[at : s.start], s.end
            assert r.text == left + text[at:]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    want = con.execute(
        f"SELECT doc_id, n_removed, removed_chars, spans, text FROM ({ORACLE['op3_substring_dedup']})"
    ).fetchall()
    assert found == {r[0]: tuple(r[1:]) for r in want}


def test_a_passage_within_lines_is_cut_from_all_but_the_first(spark):
    passage = " ".join(f"Here are seven words of sentence {w}." for w in "abcdefghij")
    rows = [(k, f"own words {k} then {passage} and {k} more own words.") for k in range(1, 6)]
    rows += [(9, "a clean text of its own, nothing repeats here at all.")]
    found = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].n_removed == 0 and found[9].n_removed == 0
    for k in range(2, 6):
        assert found[k].removed_chars > 0.7 * len(passage)
        assert {s.first for s in found[k].spans} == {1}
        assert found[k].text.startswith(f"own words {k} then")


def cut(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    return {r.doc_id: r for r in line_dedup.dedup(df, **kw).collect()}


def made_words(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulrstn") for _ in range(rng.randint(2, 9)))
    return lambda n: [word() for _ in range(n)]


def test_a_passage_without_ends_is_cut_by_content(spark):
    some = made_words(9)
    passages = [" ".join(some(80)) for _ in range(10)]
    rows = [(k, " ".join([*some(30 + k), passages[k % 10], *some(20)])) for k in range(40)]
    found = cut(spark, rows)
    assert all(found[k].n_removed == 0 for k in range(10))
    shares = [found[k].removed_chars / len(passages[k % 10]) for k in range(10, 40)]
    # the words before the first mark and after the last stay
    assert 0.3 < min(shares) and 0.65 < sum(shares) / 30 and max(shares) < 1.01


def test_passages_of_short_sentences_short_lines_and_other_line_ends(spark):
    some = made_words(3)
    words = some(78)
    sentences = " ".join(" ".join(words[k : k + 3]) + "." for k in range(0, 78, 3))
    lines = "\n".join(" ".join(words[k : k + 3]) for k in range(0, 78, 3))
    for passage in (sentences, lines):
        rows = [(k, " ".join(some(20 + k)) + " " + passage + " " + " ".join(some(15))) for k in (1, 2)]
        found = cut(spark, rows)
        assert found[1].n_removed == 0 and found[2].removed_chars > 0.8 * len(passage)
    wrapped = [words[:]] + [[w + "\n" if k % n == 0 else w for k, w in enumerate(words)] for n in (9, 14)]
    rows = [(k, " ".join([*some(20), *own, *some(20)])) for k, own in enumerate(wrapped)]
    found = cut(spark, rows)
    # pieces that end at a line's end are not shared, those that cross it are
    assert found[0].n_removed == 0 and min(found[k].removed_chars for k in (1, 2)) > 150


@pytest.mark.parametrize("passage", ["A" * 90 + "b" * 50, "".join(chr(0x4E00 + k * 7 % 3000) for k in range(140))])
def test_lines_without_spaces(spark, passage):
    found = cut(spark, [(1, f"first\n{passage}\nend"), (2, f"other words\n{passage}\nhere")])
    assert found[1].n_removed == 0 and found[2].text == "other words\n\nhere"
    inside = "".join(chr(0x3041 + k * 5 % 80) for k in range(60))
    if passage[0] != "A":
        found = cut(spark, [(1, inside[:31] + passage), (2, inside[5:50] + passage + inside)])
        assert found[2].removed_chars > 90 and found[1].n_removed == 0


def test_repeats_of_few_words_stay_unless_asked_for(spark):
    rows = [(k, f"number {k} is of its own\nall rights to these words are reserved\nbut {k}") for k in range(5)]
    assert all(r.n_removed == 0 and r.text == dict(rows)[i] for i, r in cut(spark, rows).items())
    found = cut(spark, rows, least_words=7)
    assert found[0].n_removed == 0
    assert all(found[k].text == f"number {k} is of its own\n\nbut {k}" and found[k].n_removed for k in range(1, 5))


def test_a_line_and_its_first_piece_may_read_alike(spark):
    assert cut(spark, [(1, "one two three four five six seven. \t")], least_words=1)[1].n_removed == 0


def test_null_ids_repeats_and_the_earliest(spark):
    line = "one line of five words"
    rows = [(None, line), (3, f"{line}\n{line}"), (3, line), (2, line.upper().replace(" ", "   "))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = line_dedup.dedup(df, least_words=4).collect()
    # two lines that go are one run
    assert sorted((r.doc_id or 0, r.n_removed, r.text) for r in found) == [
        (0, 1, ""), (2, 0, rows[3][1]), (3, 1, ""), (3, 1, ""),
    ]
    assert {s.first for r in found for s in r.spans} == {2}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup(empty).collect() == []


def test_a_very_long_text_of_one_word(spark):
    found = cut(spark, [(1, "go " * 300_000), (2, "x" * 2_000_000)])
    assert found[1].text.split() and len(found[1].text.split()) < 100 and found[2].n_removed == 1
