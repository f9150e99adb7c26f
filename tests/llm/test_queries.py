"""The registered queries over whole tables, against SQL or brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import pytest

from subledger.llm import queries
from tests.llm import test_byte_bpe, test_decontaminate, test_simhash, test_suffix_dedup, test_token_files, test_warc

SF = "/root/testdata/sf0.001"


def table(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]


def result(spark, name):
    return sorted((tuple(r) for r in queries.QUERIES[name](spark, SF).collect()), key=repr)


def test_one_query_per_operator():
    assert [re.match(r"op(\d+)_", n)[1] for n in queries.queries()] == [str(i) for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=repr)
    assert rows == sorted(want.fetchall() if hasattr(want, "fetchall") else want, key=repr)


def test_op1(spark):
    from tests.llm.test_html_extract import article_of

    want = [(i, u, t := article_of(h), len(t)) for i, u, h in table(spark, "pages", "page_id", "url", "html")]
    assert result(spark, "op1_html_extract") == sorted(want, key=repr)


def test_op2(spark):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, text in table(spark, "documents", "doc_id", "text"):
        ids = test_byte_bpe.tiktoken_ids(text or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert result(spark, "op2_byte_bpe") == sorted(want, key=repr)


def test_op3(spark):
    assert result(spark, "op3_suffix_dedup") == test_suffix_dedup.brute(table(spark, "documents", "doc_id", "text"))


def test_op4(spark):
    docs = table(spark, "documents", "doc_id", "text")
    fps = [test_simhash.plain_fingerprint(t or "") for _, t in docs]
    root = test_simhash.plain_components(fps)
    low = {}
    for (i, _), r in zip(docs, root, strict=True):
        low[r] = min(low.get(r, i), i)
    want = [(i, f"{f:016x}", low[r]) for (i, _), f, r in zip(docs, fps, root, strict=True)]
    assert result(spark, "op4_simhash_near_dedup") == sorted(want, key=repr)


def test_op5(spark):
    want = test_decontaminate.brute(table(spark, "documents", "doc_id", "text"), table(spark, "benchmark", "item_id", "text"))
    want = [(i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), c) for i, n, h, x, c in want]
    assert result(spark, "op5_decontamination") == sorted(want, key=repr)


def test_op6(spark):
    rows = {r[0]: r for r in result(spark, "op6_language_id")}
    docs = table(spark, "documents", "doc_id", "text", "lang")
    assert len(rows) == len(docs)
    langs, right, held = {x for _, _, x in docs}, 0, 0
    for i, text, lang in docs:
        _, held_out, label, score = rows[i]
        assert held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= score <= 1
        assert label in langs if any(c.isalpha() for c in text or "") else label == "und"
        held, right = held + held_out, right + (held_out and label == lang)
    assert right / held > 0.95


def test_op9(spark):
    want = test_token_files.brute(table(spark, "documents", "doc_id", "text"))
    assert result(spark, "op9_token_files") == sorted(want, key=repr)


def test_op10(spark):
    assert result(spark, "op10_warc") == test_warc.brute(table(spark, "pages", "page_id", "url", "html"))
