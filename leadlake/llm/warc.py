"""WARC archives: written by distributed tasks, read back sequentially.

An archive is a series of gzip members, one record each. The reader inflates a member bit by bit, takes the
header up to its empty line, frames the block by Content-Length, and hashes block and payload as they pass; it
holds one chunk of input and, if payloads are asked for, one payload. Records whose payload another record of a
smaller id holds are written as `revisit` records without the payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm.common import arrow_column, tidy

CHUNK = 64 << 10
#: Compressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20
#: Fixed values of the format.
VERSION, NEWLINE, RECORD_END = b"WARC/1.1", b"\r\n", b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page:{}>"

RECORD = (
    "archive string, position long, record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, problem string, payload binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def header_text(value: str) -> str:
    """A value that fits one header line: control characters, spaces and non-ASCII as %XX."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in value.encode("utf-8"))


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP header, which states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", RECORD_ID.format("" if page_id is None else page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{base32(hashlib.sha1(payload).digest())}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", header_text(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", RECORD_ID.format(refers_to))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode("ascii")
    return VERSION + NEWLINE + head + NEWLINE + block + RECORD_END


def gzip_member(data: bytes, level: int = 6) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class Damaged(Exception):
    """The rest of an archive can't be framed."""


class Members:
    """The gzip members of a stream, inflated in chunks."""

    def __init__(self, stream):
        self.stream, self.raw, self.out, self.start = stream, b"", b"", 0
        self.taken = 0  # bytes taken from the stream

    def next(self) -> bool:
        """Go to the next member; false at the end of the archive."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            self.taken += len(self.raw)
        self.start = self.taken - len(self.raw)
        self.inflate, self.out = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate up to one more chunk; false when the member has ended."""
        while not self.inflate.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                self.taken += len(self.raw)
                if not self.raw:
                    raise Damaged("member cut short")
            try:
                got = self.inflate.decompress(self.raw, CHUNK)
            except zlib.error as error:
                raise Damaged(f"bad gzip member: {error}") from error
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                self.out += got
                return True
        return False

    def line(self) -> bytes:
        searched = 0
        while (at := self.out.find(NEWLINE, searched)) < 0:
            searched = max(0, len(self.out) - 1)
            if not self.more():
                raise Damaged("header cut short")
        line, self.out = self.out[:at], self.out[at + 2 :]
        return line

    def fields(self) -> dict[str, str]:
        found = {}
        while line := self.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            found[name.strip().lower()] = value.strip()
        return found

    def chunks(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.out and not self.more():
                raise Damaged("block cut short")
            got, self.out = self.out[:size], self.out[size:]
            size -= len(got)
            yield got

    def rest(self) -> bytes:
        """What the member still holds; of more than the empty lines that should be there, the beginning."""
        while len(self.out) <= len(RECORD_END) and self.more():
            pass
        kept, self.out = self.out[: len(RECORD_END) + 1], b""
        while self.more():
            self.out = b""
        return kept


def http_split(chunks: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """HTTP header fields of a block, and the payload bytes that came in the same chunk."""
    seen = b""
    for chunk in chunks:
        seen += chunk
        if (at := seen.find(RECORD_END)) >= 0:
            lines = seen[:at].split(NEWLINE)[1:]
            pairs = (x.decode("latin-1").partition(":") for x in lines)
            return {n.strip().lower(): v.strip() for n, _, v in pairs}, seen[at + 4 :]
    raise ValueError("no HTTP header")


def read_record(members: Members, with_payload: bool) -> dict:
    """The record of the current member. What can be told but is wrong stands in `problem`."""
    if members.line() != VERSION:
        raise Damaged("no WARC/1.1 record")
    fields = members.fields()
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no Content-Length")
    block, payload, kept, problem = hashlib.sha1(), hashlib.sha1(), [], None

    def passing():
        for chunk in members.chunks(int(fields["content-length"])):
            block.update(chunk)
            yield chunk

    passed, length = passing(), 0
    try:
        http, chunk = http_split(passed)
        while chunk is not None:
            payload.update(chunk)
            length += len(chunk)
            if with_payload:
                kept.append(chunk)
            chunk = next(passed, None)
    except ValueError as error:
        http, problem = {}, str(error)
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = fields.get("warc-type") == "revisit"
    if revisit:
        length = int(http.get("content-length", "0"))
    elif base32(payload.digest()) != stated:
        problem = problem or "payload digest differs"
    elif http.get("content-length", str(length)) != str(length):
        problem = problem or "payload length differs"
    if fields.get("warc-block-digest", "").removeprefix("sha1:") != base32(block.digest()):
        problem = problem or "block digest differs"
    if members.rest() != RECORD_END:
        problem = problem or "no empty lines at the record's end"
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": length,
        "payload_digest": stated,
        "problem": problem,
        "payload": b"".join(kept) if with_payload and not revisit else None,
    }


def records(stream, with_payload: bool = False) -> Iterator[dict]:
    """Records of an open archive in order. A record that can't be framed gives a last row that says why."""
    members, position = Members(stream), 0
    try:
        while members.next():
            position = members.start
            yield {"position": position} | read_record(members, with_payload)
    except Damaged as error:
        yield {"position": position, "problem": str(error)}


def with_first_copy(pages: DataFrame, *, min_payload: int = 0) -> DataFrame:
    """`pages` (page_id, url, payload) with `refers_to`: the smallest page_id of an equal payload of at least
    `min_payload` bytes, null where that is the row's own or there is no other row.

    Ids are grouped by digest with partial minima; only ids and digests of repeated payloads are joined, so a
    payload that a third of all pages share moves 28 bytes a page and AQE can split it.
    """
    digest = F.unhex(F.sha1("payload"))
    keyed = pages.where(F.octet_length("payload") >= min_payload).select("page_id", digest.alias("digest"))
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    later = keyed.join(firsts.where("n > 1").drop("n"), "digest").where("not (page_id <=> first)")
    later = later.select(F.col("page_id").alias("later_id"), "digest", F.col("first").alias("refers_to")).distinct()
    same = F.col("page_id").eqNullSafe(F.col("later_id")) & (digest == F.col("digest"))
    return pages.join(later, same, "left").select("page_id", "url", "payload", "refers_to")


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_payload: int = 0,
    date: str = "2026-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of `pages` into archives under `folder`; returns their list (archive, records).

    The list is lazy: save it before use, as each evaluation writes archives anew. Names are made by each task
    attempt, so a repeated task leaves an archive that no list names. `folder` is any address that
    pyarrow.fs opens. Null html is an empty payload, a null url no target. Rows that share the smallest id of
    a payload are responses all; a null id is written empty and never referred to. Other columns are not read.
    """
    html = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = with_first_copy(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("payload")),
        min_payload=min_payload,
    )

    def write(batches):
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path)
        out, written = None, []
        for batch in batches:
            columns = [arrow_column(batch, c) for c in ("page_id", "url", "payload", "refers_to")]
            for row in zip(*columns, strict=True):
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    written.append([f"part-{uuid4().hex}.warc.gz", 0])
                    out = where.open_output_stream(f"{path}/{written[-1][0]}", compression=None)
                page_id, url, payload, refers_to = (x.as_py() for x in row)
                out.write(gzip_member(record_bytes(page_id, url, payload, refers_to, date)))
                written[-1][1] += 1
        if out is not None:
            out.close()
        names, counts = [f"{folder}/{n}" for n, _ in written], [c for _, c in written]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return rows.mapInArrow(tidy(write), "archive string, records long")


def read_archives(archives: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives listed in `archives` (archive): see RECORD.

    Each archive is read by one task from start to end. `problem` is null for a sound record; a damaged one is a
    row that says what is wrong, and where framing is lost the rest of that archive is one row. An empty archive
    gives no row. Payloads are kept on request only.
    """

    def read(batches):
        for batch in batches:
            for name in arrow_column(batch, "archive").to_pylist():
                where, path = fs.FileSystem.from_uri(name)
                with where.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for row in records(stream, with_payload):
                        rows.append({"archive": name} | row)
                        held += len(row.get("payload") or b"")
                        if len(rows) == 1000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)

    spread = archives.select("archive").repartition(max(1, archives.count()))
    return spread.mapInArrow(tidy(read), RECORD)


ARROW_RECORD = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (x.split() for x in RECORD.split(", "))
    ]
)


def page_number(record_id: str):
    """The id inside a record id column, null where it is empty."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(.*)>$", 1), F.lit("")).try_cast("long")
