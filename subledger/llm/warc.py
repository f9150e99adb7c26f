"""WARC archives from pages, and a normaliser for monolithic gzip.

``archives`` writes a WARC record per page; an archive is one gzip stream over
all its records. ``normalised`` inflates such a stream once, in pieces, rewrites
every record as a gzip member of its own and adds the sidecar index: offset and
length of each member. With the index a record is read by inflating its member
alone; ``read`` does that and checks each payload against its digest.

Archives are rows (name, data) in Parquet tables, so that any storage Spark
reads will do and a lost task leaves no half-written file; ``data`` of a row,
written to a file, is a ``.warc.gz``. An archive is closed once it holds
``ARCHIVE_BYTES`` of records, or one record that is longer.

Of pages with equal payloads of at least ``least`` bytes the one with the
largest page_id is a response and the others are revisits of it; a null page_id
is smaller than any other, and if it is the largest, all are responses. Rows
that repeat the largest page_id are responses too. Very long pages are read and written whole; an
archive and one page are the largest things a task holds. A null html is the empty
payload, a null url has no target header, control characters in urls are
percent-encoded. Streams cut short or with text between records raise a
ValueError. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import ship, stored

ARCHIVE_BYTES = 4 << 20
#: Most digests that occur more than once (60 bytes a row) to broadcast; beyond it pages are shuffled.
BROADCAST_ROWS = 100_000
PIECE = 1 << 18
#: All records carry one date: a run over the same pages gives the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{NO_ID if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == NO_ID else int(text)


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None) -> bytes:
    """A response record, or without payload a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {urn(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32(sha1_hex)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes | memoryview) -> dict[str, str]:
    lines = bytes(data).decode("utf-8").split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, piece by piece."""
    engine = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            if engine.eof:
                engine = zlib.decompressobj(31)
            if out := engine.decompress(chunk, PIECE):
                yield out
            chunk = engine.unused_data if engine.eof else engine.unconsumed_tail
    if not engine.eof:
        raise ValueError("the gzip stream is cut short")


def records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The records in a stream of bytes; holds one record and one piece at most."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                if held and not b"WARC/".startswith(bytes(held[:5])):
                    raise ValueError("a record does not begin with WARC/")
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(held[:end])["content-length"]) + 4
            if len(held) < need:
                break
            if held[need - 4 : need] != b"\r\n\r\n":
                raise ValueError("a record is not as long as it says")
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the last record is cut short")


def gzipped(data: bytes, level: int) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def normalise(chunks: Iterable[bytes], level: int = 6) -> Iterator[tuple[bytes, str]]:
    """(gzip member, record id) for every record of a gzip file."""
    for data in records(inflated(chunks)):
        head = headers(data[: data.index(b"\r\n\r\n")])
        yield gzipped(data, level), head["warc-record-id"]


def typed(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 (hex) and refers_to (null for responses)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    # decided on digests alone; the pages themselves stay where they are
    thin = pages.select("page_id", F.sha1(payload).alias("sha1")).where(F.octet_length(payload) >= least)
    shared = stored(
        thin.groupBy("sha1").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "warc-shared",
    )
    side = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    full = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    return full.join(side, "sha1", "left").select(
        "page_id", "url", "payload", "sha1", refers.alias("refers_to")
    )


def archives(pages: DataFrame, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Monolithic archives of all pages, of ``archive_bytes`` or one record more, stored: name, data."""
    ship(pages.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine, out, size, n, part = None, [], 0, 0, 0

        def close() -> pd.DataFrame:
            return pd.DataFrame({"name": [f"{part:06d}-{n:06d}.warc.gz"], "data": [b"".join(out) + engine.flush()]})

        for batch in batches:
            for part, page, url, payload, sha1, refers in batch.itertuples(index=False, name=None):
                engine = engine or zlib.compressobj(1, zlib.DEFLATED, 31)
                data = record(
                    None if page is None else int(page), url, bytes(payload), sha1,
                    None if refers is None else int(refers),
                )
                out.append(engine.compress(data))
                size += len(data)
                if size >= archive_bytes:
                    yield close()
                    engine, out, size, n = None, [], 0, n + 1
        if engine:
            yield close()

    rows = typed(pages, least).select(  # ids as text: pandas has no null integers
        F.spark_partition_id().alias("part"), F.col("page_id").cast("string"), "url", "payload", "sha1",
        F.col("refers_to").cast("string"),
    )
    return stored(rows.mapInPandas(write, "name string, data binary"), "warc")


INDEX = "array<struct<id:string,offset:long,length:long>>"
INDEX_TYPE = pa.list_(pa.struct([("id", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))


def normalised(files: DataFrame) -> DataFrame:
    """``files`` (name, data) with a gzip member per record, and the sidecar index; stored."""
    ship(files.sparkSession)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("name"), batch.column("data"), strict=True):
                view, members, index, at = memoryview(data.as_buffer()), [], [], 0
                for member, key in normalise(bytes(view[i : i + PIECE]) for i in range(0, len(view), PIECE)):
                    index.append({"id": key, "offset": at, "length": len(member)})
                    members.append(member)
                    at += len(member)
                yield pa.RecordBatch.from_pydict(
                    {"name": [name.as_py()], "data": pa.array([b"".join(members)], pa.binary()), "index": pa.array([index], INDEX_TYPE)})

    return stored(files.mapInArrow(rewrite, f"name string, data binary, index {INDEX}"), "warc-members")


def read(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every indexed record."""
    ship(files.sparkSession)

    def one(member: bytes) -> tuple:
        data = zlib.decompress(member, 31)
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = headers(head)
        block = rest[: int(fields["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(headers(http)["content-length"])
        kind = fields["warc-type"]
        if kind == "response" and (base32(hashlib.sha1(payload).hexdigest()), len(payload)) != (digest, size):
            raise ValueError(f"the payload of {fields['warc-record-id']} is not what its header says")
        refers = fields.get("warc-refers-to")
        return page_of(fields["warc-record-id"]), size, digest, kind, page_of(refers) if refers else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, index in zip(batch["data"], batch["index"], strict=True):
                rows = [one(data[x["offset"] : x["offset"] + x["length"]]) for x in index]
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)
                yield out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.select("data", "index").mapInPandas(run, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages to archives, archives to members, members to their records' fields."""
    return read(normalised(archives(pages, least)))
