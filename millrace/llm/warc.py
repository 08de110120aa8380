"""WARC archives: deduplicated records written as gzip members, and a splittable reader.

Writing goes through Spark's text writer and so through its commit protocol and any file
system it knows: a row's value is the bytes of one gzip member.  The writer ends each row with a
line separator, which here is an empty gzip member, so a file is a plain series of members.

Reading never needs a whole file.  Spark cuts files into byte ranges; its line reader, with the gzip magic
as the separator, hands each task the pieces between magics that begin inside its range.  The magic may
also occur inside compressed data, so a piece is only a candidate: it begins a record if its bytes decode to
a WARC header, and is joined with the pieces behind it until its member ends.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, written

MAGIC = b"\x1f\x8b\x08"
_PACK = zlib.compressobj(6, zlib.DEFLATED, 31)
EMPTY_MEMBER = _PACK.compress(b"") + _PACK.flush()
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
LENGTH_FIELD = "X-Payload-Length"


def base32(sha1_hex: str) -> str:
    """A SHA-1 as archives print it: base32, upper case."""
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _urn(record_id: str) -> str:
    return f"<urn:page:{quote(record_id, safe='')}>"


def member(record_id: str, kind: str, uri: str, payload: bytes, sha1_hex: str, length: int, refers_to: str | None) -> bytes:
    """One record, compressed; a revisit has no payload, but its digest and length."""
    head = [
        VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(record_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32(sha1_hex)}", f"{LENGTH_FIELD}: {length}", "Content-Type: text/html",
        f"Content-Length: {len(payload)}",
    ]
    if uri:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """``(id, uri, payload, bytes, sha1, kind, refers_to)`` of every row of ``pages``.

    Of equal payloads of at least ``least_bytes``, the one with the largest id is the response and the others refer
    to it.  Only digests held more than once are joined back; a digest of very many pages is a skewed
    join, which adaptive execution splits, and its largest id is found before the shuffle.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").alias("uri"), as_bytes(F.col(f"`{payload_col}`")).alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("sha1").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Written first, so that the join is one of two plain shuffles.
    joined = rows.join(written(copies.select("sha1", "first"), "copies"), "sha1", "left")
    again = (F.col("first") != F.col("id")) & (F.col("bytes") >= least_bytes)
    again = F.coalesce(again, F.col("id").isNull() & F.col("first").isNotNull() & (F.col("bytes") >= least_bytes))
    return joined.select("id", "uri", "payload", "bytes", "sha1", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> None:
    """One record for every row, as archives below ``path``.

    A null payload is empty and a null address is left out.  A row without an id is written with an empty id and is never
    referred to.  Rows that repeat an id are records of their own; with one payload, all those of the largest id are responses.
    An empty table writes no record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = zip(*(batch.column(k) for k in range(7)), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([member(*(c.as_py() for c in row)) for row in cells], pa.binary())], ["member"])

    rows = with_revisits(pages, id_col, uri_col, payload_col, least_bytes).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")), "kind", F.coalesce("uri", F.lit("")),
        F.when(F.col("kind") == "response", F.col("payload")).otherwise(F.lit(b"")), "sha1", "bytes", F.col("refers_to").cast("string"))
    members = rows.toDF("id", "kind", "uri", "payload", "sha1", "bytes", "refers_to").mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


def parsed(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields, lower-cased, and payload of an uncompressed record; None if it is none."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        return None
    return fields, rest[:int(fields["content-length"])]


class _Member:
    """A member that is being put together from the pieces between magics."""

    def __init__(self) -> None:
        self.unpack = zlib.decompressobj(31)
        self.out: list[bytes] = []
        self.sound = True

    def add(self, piece: bytes) -> None:
        try:
            self.out.append(self.unpack.decompress(MAGIC + piece))
        except zlib.error:
            self.sound = False
        head = b"".join(self.out)[:5] if len(self.out) < 6 else b"WARC/"
        # it goes on as long as it decodes, to nothing yet or to a WARC header
        self.sound = self.sound and (b"WARC/".startswith(head) if len(head) < 5 else head == b"WARC/")

    def record(self, with_payload: bool) -> dict | None:
        """The record of an ended member; None for an empty member, or if length or digest do not hold."""
        found = parsed(b"".join(self.out))
        if found is None:
            return None
        fields, body = found
        ident = lambda k: unquote(fields[k][len("<urn:page:"):-1]) if k in fields else None
        written_digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        kind = fields.get("warc-type")
        sound = kind == "revisit" or base32(hashlib.sha1(body).hexdigest()) == written_digest
        length = fields.get(LENGTH_FIELD.lower(), fields["content-length"])
        return {
            "record_id": ident("warc-record-id"), "record_type": kind, "target_uri": fields.get("warc-target-uri"),
            "payload_digest": written_digest, "payload_bytes": int(length), "refers_to": ident("warc-refers-to"),
            "sound": sound and (kind == "revisit" or int(length) == len(body)), "payload": body if with_payload else None}


class _Assembler:
    """Members from a series of pieces.

    A piece that cannot begin a member is passed over.  When an attempt fails, the piece behind its beginning is
    tried next, so a damaged member or a magic by chance never hides the members behind it.
    """

    def __init__(self, with_payload: bool) -> None:
        self.with_payload = with_payload
        self.pending: list = []   # (place, piece) from the beginning of the attempt
        self.member: _Member | None = None

    def feed(self, place, piece: bytes) -> Iterator[tuple[dict | None, list]]:
        """For what is settled with this piece: its record, or None, and its (place, piece) pairs."""
        ahead = [(place, piece)]
        while ahead:
            self.pending.append(ahead.pop(0))
            if self.member is None:
                self.member = _Member()
            self.member.add(self.pending[-1][1])
            if not self.member.sound:
                ahead, settled = [*self.pending[1:], *ahead], self.pending[:1]
                self.pending, self.member = [], None
                yield None, settled
            elif self.member.unpack.eof:
                record, settled = self.member.record(self.with_payload), self.pending
                self.pending, self.member = [], None
                yield record, settled


_RECORD = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("sound", pa.bool_()), ("payload", pa.binary()),
])
_LEFT = [("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())]
_BOTH = pa.schema([*_RECORD, *_LEFT])
_RECORD_DDL = (
    "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to string, "
    "sound boolean, payload binary")
_BOTH_DDL = f"{_RECORD_DDL}, file string, start long, n long, bytes binary"


def _assembled(with_payload: bool):
    """Records from (file, start of range, piece) rows, which come in the order of the file.

    What a range cannot settle is left over: all before its first record (it may belong to one that began in
    an earlier range) and what has not ended with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, opened, maker = None, 0, False, _Assembler(with_payload)

        def left(pieces: list) -> list[dict]:
            return [{"file": at[0], "start": at[1], "n": k, "bytes": p} for k, p in pieces]

        for batch in batches:
            out = []
            for file, start, piece in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (file, start) != at:
                    out += left(maker.pending)
                    at, n, opened, maker = (file, start), 0, start == 0, _Assembler(with_payload)
                n += 1
                if start == 0 and n == 1 and not piece:  # what stands before the file's first magic
                    continue
                for record, settled in maker.feed(n, piece):
                    if record:
                        opened = True
                        out.append(record)
                    elif not opened:
                        out += left(settled)
            yield pa.RecordBatch.from_pylist(out, schema=_BOTH)
        if maker.pending:
            yield pa.RecordBatch.from_pylist(left(maker.pending), schema=_BOTH)

    return run


def _across(with_payload: bool):
    """Members that go over a range's end, from one file's left-over pieces.  Those that do not belong together fail their checksum."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        maker, out = _Assembler(with_payload), []
        for start, n, piece in group.sort_values(["start", "n"])[["start", "n", "bytes"]].itertuples(index=False):
            out += [record for record, _ in maker.feed((start, n), bytes(piece)) if record]
        ahead = [piece for _, piece in maker.pending]
        while len(ahead) > 1:  # the last attempt never ended: try what stands behind its beginning
            ahead, maker = ahead[1:], _Assembler(with_payload)
            for k, piece in enumerate(ahead):
                out += [record for record, _ in maker.feed(k, piece) if record]
            ahead = [piece for _, piece in maker.pending]
        return pd.DataFrame(out, columns=_RECORD.names)

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives at ``path``: ids, type, address, digest, length, ``sound`` and the payload.

    ``sound`` tells whether a payload has the length and digest its record states.  Members that hold no record and
    damaged ones are passed over; the records behind them are found again.  ``with_payload=False`` checks payloads
    where they are read and returns null for them.
    """
    pieces = (
        spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
        .select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary")))
    found = written(pieces.mapInArrow(_assembled(with_payload), _BOTH_DDL), "records")
    whole = found.where("file IS NULL").select(*_RECORD.names)
    across = found.where("file IS NOT NULL").groupBy("file").applyInPandas(_across(with_payload), _RECORD_DDL)
    return whole.unionByName(across)
