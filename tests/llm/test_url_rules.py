import random

import pytest

from shelfweek.llm import url_rules
from tests.llm import brute


def made(seed):
    rng = random.Random(seed)
    label = lambda: rng.choice(["com", "net", "a", "b", "a-b", "example", "www", "x!"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: "".join(rng.choice(["/", "a", "b", "en/", "/e"]) for _ in range(rng.randint(0, 4)))
    rules = {(host(3), path()): rng.choice(["allow", "block"]) for _ in range(60)}
    urls = [
        f"{rng.choice(['http://', 'https://', '://', ''])}{host(5)}{rng.choice(['', '/', ''])}{path()}{rng.choice(['', '?q=/a', '#f', '?a#b'])}"
        for _ in range(500)
    ]
    urls += [None, "", "://", "http://", "HTTP://A.Example.COM/en/x", "http://É.com/a", "http://com", "x://a://b/c"]
    return urls, [(h, p, v) for (h, p), v in rules.items()]


@pytest.mark.parametrize("rows_each", [50_000, 20])
def test_equals_brute_force_in_one_and_in_many_partitions(spark, monkeypatch, rows_each):
    monkeypatch.setattr(url_rules, "PARTITION_ROWS", rows_each)
    urls, rules = made(3)
    # the longer host wins among equal lengths, which brute force says as well
    df = spark.createDataFrame([(k, u, "h", "r", 5) for k, u in enumerate(urls)], "page_id long, url string, host string, rule string, _row int")
    listed = spark.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    found = {r.page_id: r for r in url_rules.judge(df, listed).collect()}
    assert len(found) == len(urls) and found[0]["_row"] == 5
    for k, url in enumerate(urls):
        rule = brute.url_rule(url, rules)
        assert (found[k].host, found[k].path) == brute.url_parts(url), url
        assert (found[k].rule, found[k].verdict) == (rule or (None, "allow")), url


def test_a_hot_host_spans_partitions_that_begin_after_its_rules(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "PARTITION_ROWS", 25)
    urls = [(k, f"http://www.example.com/en/{k % 7}") for k in range(200)]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/3", "allow")]
    found = url_rules.judge(
        spark.createDataFrame(urls, "page_id long, url string"),
        spark.createDataFrame(rules, "host string, path string, verdict string"),
    ).collect()
    assert {(r.path, r.rule) for r in found} == {
        (f"/en/{k}", "www.example.com/en/3" if k == 3 else "example.com/en/") for k in range(7)
    }
    assert len(found) == 200


def test_empty_tables_null_paths_and_repeats(spark):
    rules = spark.createDataFrame([("Com", None, "block"), ("com", "", "block")], "host string, path string, verdict string")
    urls = spark.createDataFrame([(1, "http://x.com")] * 2 + [(None, "http://org")], "page_id long, url string")
    found = sorted((r.page_id or 0, r.rule, r.verdict) for r in url_rules.judge(urls, rules).collect())
    assert found == [(0, None, "allow"), (1, "com", "block"), (1, "com", "block")]
    assert url_rules.judge(urls.limit(0), rules).collect() == []
    assert {r.verdict for r in url_rules.judge(urls, rules.limit(0), default="block").collect()} == {"block"}
