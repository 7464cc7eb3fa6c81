import base64
import gzip
import hashlib
import os
import random

import pytest

from shelfweek.llm import warc

SCHEMA = "page_id long, url string, html string, path string, _row int, key int"


@pytest.fixture(autouse=True)
def _many_ranges_a_task(monkeypatch):
    monkeypatch.setattr(warc, "SPLITS_A_TASK", 300)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).repartition(3)


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data]
        first = min(same, key=lambda j: (j is None, j or 0))
        held = len(data) < least or i == first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if held else "revisit", None if held else first))
    return sorted(out, key=str)


def read(records):
    return sorted(
        (
            (
                None if r.source_id is None else int(r.source_id),
                r.payload_bytes,
                r.payload_digest,
                r.record_type,
                None if r.refers_to_source_id is None else int(r.refers_to_source_id),
            )
            for r in records
        ),
        key=str,
    )


def made(n, seed=2):
    rng = random.Random(seed)
    html = lambda k: rng.choice(["", None, "same", "<p>é</p>" * rng.randint(1, 900), f"{k}" * rng.randint(1, 50)])
    return [(k * 7 % n, rng.choice([f"http://h/{k}", None, "x\r\nWARC-Type: bad", "http://é/"]), html(k)) for k in range(n)]


@pytest.mark.parametrize("split, least", [(64, 0), (1000, 4), (None, 5)])
def test_round_trip_whatever_the_ranges(spark, tmp_path, split, least):
    rows = made(120)
    files = warc.write_archives(pages(spark, rows), str(tmp_path / "a"), least=least)
    records = warc.read_archives(files, with_payload=True, split_bytes=split)
    got = records.collect()
    assert read(got) == expected(rows, least)
    assert all(r.intact for r in got) and {r.lost for r in warc.uncovered(files, records).collect()} == {0}
    texts = {r.source_id: r.payload for r in got if r.record_type == "response"}
    assert all(bytes(texts[str(i)]).decode() == (html or "") for i, _, html in rows if str(i) in texts)
    ids = {r.record_id: r.source_id for r in got}
    assert len(ids) == len(rows)
    assert all(ids[r.refers_to] == r.refers_to_source_id for r in got if r.record_type == "revisit")
    assert {f.records for f in files.collect()} and sum(f.records for f in files.collect()) == len(rows)


def test_archives_are_plain_gzip_files_of_warc_records(spark, tmp_path):
    files = warc.write_archives(pages(spark, made(30)), str(tmp_path / "a"))
    listed = {os.path.basename(r.path) for r in files.collect()}
    assert listed == set(os.listdir(tmp_path / "a"))
    for name in listed:
        with gzip.open(tmp_path / "a" / name) as f:
            text = f.read()
        assert text.startswith(b"WARC/1.1\r\n") and b"\r\nWARC-Type: bad" not in text


def test_archives_are_rolled_and_repeats_and_null_ids_kept(spark, tmp_path, monkeypatch):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (2, None, None), (None, None, "b")]
    files = warc.write_archives(spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).coalesce(1), str(tmp_path / "a"))
    got = read(warc.read_archives(files).collect())
    kinds = [(r[0], r[3], r[4]) for r in got]
    assert sorted(kinds, key=str) == sorted(
        [(1, "response", None), (1, "revisit", 1), (None, "revisit", 1), (2, "response", None), (None, "response", None)], key=str
    )
    empty = warc.write_archives(pages(spark, []), str(tmp_path / "b"))
    assert warc.read_archives(empty).collect() == []


def test_members_inside_payloads_are_not_records(spark, tmp_path):
    inner = warc.member(warc.record([("WARC-Type", "resource"), ("Content-Type", "text/plain")], random.Random(1).randbytes(2000)))
    noise = random.Random(2).randbytes(3000)
    payload = noise + inner + noise + inner + warc.MAGIC + noise
    rows = spark.createDataFrame([(k, "u", bytearray(payload + bytes([k]))) for k in range(4)], "page_id long, url string, html binary")
    files = warc.write_archives(rows.coalesce(1), str(tmp_path / "a"))
    for split in (50, 5000):
        records = warc.read_archives(files, with_payload=True, split_bytes=split)
        got = records.collect()
        assert sorted(r.source_id for r in got) == ["0", "1", "2", "3"]
        assert all(bytes(r.payload) == payload + bytes([int(r.source_id)]) for r in got)
    # a member stored as it is, by a writer that does not part it, would be found
    assert gzip.decompress(warc.member(payload)) == payload and inner not in warc.member(payload)


def test_damage_is_passed_over_and_told(spark, tmp_path):
    whole = [warc.member(warc.record([("WARC-Type", "resource"), ("Source-ID", str(k))], b"x%d" % k * 400)) for k in range(5)]
    whole[2] = whole[2][:40] + b"\0\0\0\0" + whole[2][44:]
    foreign = warc.member(b"no record at all")
    data = b"".join(whole[:4]) + foreign + whole[4]
    (tmp_path / "x.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file:{tmp_path}/x.warc.gz", len(data))], "path string, bytes long")
    for split in (30, 10_000):
        records = warc.read_archives(files, with_payload=True, split_bytes=split)
        got = sorted((r.source_id, bytes(r.payload), r.payload_bytes) for r in records.collect())
        assert got == [(str(k), b"x%d" % k * 400, 800) for k in (0, 1, 3, 4)]
        assert warc.uncovered(files, records).first().lost == len(whole[2]) + len(foreign)
