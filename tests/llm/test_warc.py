from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pytest

from subledger.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA)


def brute(rows, least=0):
    largest, n = {}, {}
    for i, _, html in rows:
        n[html or ""] = n.get(html or "", 0) + 1
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    out = []
    for i, _, html in rows:
        data, top = (html or "").encode(), largest.get(html or "")
        revisit = n[html or ""] > 1 and len(data) >= least and top is not None and i != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/ \r\n\x7f", None), (4, "u", ""), (None, "n", "<p>x</p>"),
    (None, "n", "only without id"), (None, "n", "only without id"), (7, "é", "é\U0001f600 \r\n\r\nWARC/1.1\r\n\r\n"),
    (8, "l", "long " * 300_000), (9, "l", "long " * 300_000), (9, "l", "long " * 300_000), (2**60 + 1, "b", "own"), (2**60, "b", "own"),
]


def test_round_trip_matches_brute_force(spark):
    rows = ROWS + [(100 + i, f"http://h/{i}", "hot" if i % 3 == 0 else f"<p>{i}</p>") for i in range(600)]
    got = warc.round_trip(pages(spark, rows))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert sorted(map(tuple, warc.round_trip(pages(spark, rows), 100).collect()), key=repr) == brute(rows, 100)


def test_archives_and_index(spark, monkeypatch):
    made = warc.archives(pages(spark, ROWS))
    files = made.collect()
    assert len({r["name"] for r in files}) == len(files)
    for r in files:
        engine = zlib.decompressobj(31)
        assert engine.decompress(r["data"]) and engine.eof and not engine.unused_data  # one member
    after = {r["name"]: r for r in warc.normalised(made).collect()}
    for r in files:
        data, index = after[r["name"]]["data"], after[r["name"]]["index"]
        assert gzip.decompress(data) == gzip.decompress(r["data"])
        assert [x["offset"] for x in index] == [sum(y["length"] for y in index[:k]) for k in range(len(index))]
        for x in index:
            one = zlib.decompress(data[x["offset"] : x["offset"] + x["length"]], 31)
            assert one.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {x['id']}".encode() in one


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_normaliser_takes_any_pieces_and_members(step):
    parts = [warc.record(i, "u", b"p" * (i * 997), hashlib.sha1(b"p" * (i * 997)).hexdigest(), None) for i in range(6)]
    whole = gzip.compress(b"".join(parts[:4])) + gzip.compress(parts[4]) + gzip.compress(parts[5])
    got = list(warc.normalise(whole[i : i + step] for i in range(0, len(whole), step)))
    assert [gzip.decompress(m) for m, _ in got] == parts
    for bad in (whole[:-9], gzip.compress(b"".join(parts)[:-3]), gzip.compress(parts[0] + b"x" + parts[1])):
        with pytest.raises(ValueError):
            list(warc.normalise([bad]))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_archives_that_fill_up_and_a_page_longer_than_one(spark):
    rows = ROWS + [(100 + i, f"http://h/{i}", f"<p>{i}</p>" * 5) for i in range(300)]
    made = warc.archives(pages(spark, rows).coalesce(2), archive_bytes=2000)
    files = made.collect()
    assert len(files) > 30 and len({r["name"] for r in files}) == len(files)
    sizes = sorted(len(gzip.decompress(r["data"])) for r in files)
    assert sizes[-1] > 1_000_000 and sizes[len(sizes) // 2] < 4000
    got = warc.read(warc.normalised(made))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_pages_are_not_shuffled_unless_very_many_digests_repeat(spark, monkeypatch):
    rows = ROWS + [(100 + i, "u", f"<p>{i % 50}</p>") for i in range(200)]
    one = warc.typed(pages(spark, rows))
    assert "Exchange hashpartitioning" not in one._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    two = warc.typed(pages(spark, rows))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
