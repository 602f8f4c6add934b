"""WARC archives: a writer, and a sequential reader that checks what it reads.

A record is one gzip member: version line, named fields, a block of ``Content-Length`` bytes, two
line ends. The writer knows from the payload digests which records repeat an earlier payload and
writes those as ``revisit`` without it. Archives are rows of the shared folder, a few MB each, so they
are written by many tasks and survive them; ``read_files`` reads the same bytes from ``.warc.gz`` files.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.frames import stored
from pulsegrid.llm.words import text_slices

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 4 << 20
READ_BYTES = 1 << 16
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "verified boolean, problem string"
)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if refers_to is not None else head + payload
    fields = [VERSION, "WARC-Type: " + ("response" if refers_to is None else "revisit"), f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    fields += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join([*fields, "", ""]).encode() + block + b"\r\n\r\n") + packer.flush()


class _Members:
    """Bytes of one gzip member after the other, inflated as far as they are asked for."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.raw = chunks, b""

    def _more(self) -> bool:
        while not self.raw:
            raw = next(self.chunks, None)
            if raw is None:
                return False
            self.raw = raw
        return True

    def open(self) -> bool:
        """Begin the next member, if there is one."""
        self.inflater, self.plain = zlib.decompressobj(31), bytearray()
        return self._more()

    def _inflate(self) -> bool:
        if self.inflater.eof or not self._more():
            return False
        self.plain += self.inflater.decompress(self.raw, READ_BYTES)
        self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = self.plain.find(mark)
        while at < 0:
            start = max(0, len(self.plain) - len(mark))
            if not self._inflate():
                raise ValueError("record head does not end")
            at = self.plain.find(mark, start)
        out = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in pieces."""
        while n:
            if not self.plain and not self._inflate():
                raise ValueError("block is shorter than its length")
            out = bytes(self.plain[:n])
            del self.plain[: len(out)]
            n -= len(out)
            if out:
                yield out

    def rest(self) -> bytes:
        while self._inflate():
            if len(self.plain) > READ_BYTES:
                break
        if not self.inflater.eof:
            raise ValueError("member does not end with its record")
        return bytes(self.plain)

    def skip(self) -> bool:
        """Inflate to the end of the member without keeping it; whether it has one."""
        self.plain.clear()
        try:
            while self._inflate():
                self.plain.clear()
        except zlib.error:
            return False
        return self.inflater.eof


def read_records(chunks: Iterator[bytes], with_payload: bool = False) -> Iterator[dict]:
    """Records in order. Length, block digest and payload digest are checked; ``problem`` says what failed.

    After a bad head, length or block the next member is read; only a damaged gzip stream ends the archive, with a
    last record that carries the problem.
    """
    members = _Members(chunks)
    while members.open():
        record: dict = {"fields": {}, "problem": None, "payload": None, "payload_bytes": None, "payload_sha256": None}
        try:
            lines = members.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
            record["fields"] = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            length = int(record["fields"]["content-length"])
            if length < 0:
                raise ValueError("length below zero")
            block, payload = hashlib.sha256(), hashlib.sha256()
            head, size, parts = bytearray(), 0, []
            in_head = "http" in record["fields"].get("content-type", "")
            for piece in members.pieces(length):
                block.update(piece)
                if in_head:
                    head += piece
                    at = head.find(b"\r\n\r\n")
                    if at < 0:
                        continue
                    in_head, piece = False, bytes(head[at + 4 :])
                    del head[at:]
                payload.update(piece)
                size += len(piece)
                if with_payload:
                    parts.append(piece)
            record |= {"head": bytes(head), "payload_bytes": size, "payload_sha256": payload.hexdigest()}
            if with_payload:
                record["payload"] = b"".join(parts)
            if members.rest() != b"\r\n\r\n":
                record["problem"] = "bytes after the block"
            elif record["fields"].get("warc-block-digest", "sha256:" + block.hexdigest()) != "sha256:" + block.hexdigest():
                record["problem"] = "block digest differs"
            elif record["fields"].get("warc-type") == "response" and record["fields"].get("warc-payload-digest") != "sha256:" + payload.hexdigest():
                record["problem"] = "payload digest differs"
        except (ValueError, KeyError, zlib.error) as error:
            record["problem"] = f"{type(error).__name__}: {error}"
            yield record
            if isinstance(error, zlib.error) or not members.skip():
                return
            continue
        yield record


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _row(record: dict) -> dict:
    fields = record["fields"]
    kind, size = fields.get("warc-type"), record["payload_bytes"]
    if kind == "revisit":  # the length of the payload that was not written again
        size = next((int(x.split(b":")[1]) for x in record.get("head", b"").split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    url = fields.get("warc-target-uri")
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "verified": record["problem"] is None,
        "problem": record["problem"],
        "payload": record["payload"],
    }


def write_archives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Write one record per row; returns the stored archives as ``body binary, records long``.

    A null payload is empty. Of equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the row with the
    smallest id is the response (rows repeating that id too), the others revisit it; without any id in
    the group all are responses. An empty table gives no archive; other columns are not read.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    long_enough = F.octet_length("payload") >= MIN_REVISIT_BYTES
    groups = rows.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    # stored, so that the planner knows how small it is before the payloads are shuffled for the join
    groups = stored(groups.where("n > 1 and first_id is not null").select("digest", "first_id"), "originals")
    marked = rows.join(groups, "digest", "left")
    refers = F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, n = bytearray(), 0
        flush = lambda: pa.RecordBatch.from_pydict({"body": pa.array([bytes(body)], pa.binary()), "records": pa.array([n], pa.int64())})
        for part in text_slices(batches, "payload"):
            for row in zip(*[part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                page_id, url, text, digest, refers_to = row
                body += write_record(page_id, url, text.encode(), digest, refers_to, date)
                n += 1
                if len(body) >= ARCHIVE_BYTES:
                    yield flush()
                    body, n = bytearray(), 0
        if n:
            yield flush()

    return stored(marked.mapInArrow(run, "body binary, records long"), "archives")


def read_archives(archives: DataFrame, body_col: str = "body", with_payload: bool = False) -> DataFrame:
    """One row per record of each archive: ids, type, payload length and digest, ``verified`` and ``problem``.

    A null or empty archive has no records. With ``with_payload`` the payload bytes of responses come along.
    """
    names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                view = memoryview(body.as_buffer() or b"")
                chunks = (bytes(view[i : i + READ_BYTES]) for i in range(0, len(view), READ_BYTES))
                rows, held = [], 0
                for record in read_records(chunks, with_payload):
                    row = _row(record)
                    held += len(row["payload"] or b"")
                    rows.append(row)
                    if len(rows) >= 10_000 or held > 32 << 20:
                        yield _batch(rows, names, types)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, types)

    return archives.select(F.col(f"`{body_col}`").alias("body")).mapInArrow(run, RECORD + ", payload binary" * with_payload)


def _batch(rows: list[dict], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)


def read_files(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of ``.warc.gz`` files (each below 2 GB, the limit of the binary file source)."""
    return read_archives(spark.read.format("binaryFile").load(path), "content", with_payload)
