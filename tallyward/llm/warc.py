"""WARC archives: a writer, a normaliser for monolithic gzip, and an indexed reader.

A monolithic archive is one gzip stream over all records, which can only be read
from its start.  The normaliser inflates such a stream once, in bounded pieces,
rewrites every record as its own gzip member, and writes a sidecar index of
offsets.  Readers then seek to any record.

Archives lie in a folder that all machines share and are reached through
pyarrow's file systems, never through a local path.  A task writes to a name of
its own and renames at the end, so a task that is run again or twice leaves one
whole archive.

Defined results: a null html is an empty payload; a null url or id is written as
an empty field.  Repeated rows are records of their own; of equal large payloads
those with the largest page_id are responses and the others refer to it.  An empty table gives no
archive and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import BROADCAST_BYTES, lacking, mapped, scratch_path, written

#: Payloads below this many bytes are never revisits.
MIN_REVISIT = 1000
PIECE = 1 << 20
#: Records that one reading task takes at a time.
SPLIT = 2000
LEVEL = 1

_INDEX, _ENTRY = "<QQ", 16  # offset and length of a member


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@dataclass(frozen=True)
class Page:
    """What a record is made of; ``refers_to`` and ``refers_url`` name the response of a revisit."""

    page_id: int | None
    url: str | None
    digest: str
    refers_to: int | None = None
    refers_url: str | None = None


def record(page: Page, payload: bytes, record_id: uuid.UUID, date: str) -> bytes:
    """One WARC record: a response with its HTTP message, or a revisit with the message's header alone."""
    uri = lambda u: (u or "").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if page.refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if page.refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri(page.url)}",
        f"WARC-Payload-Digest: sha1:{page.digest}",
        f"X-Page-ID: {'' if page.page_id is None else page.page_id}",
    ]
    if page.refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Target-URI: {uri(page.refers_url)}",
                  f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {page.refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _finish(target: fs.FileSystem, own: str, final: str) -> None:
    """Rename; if the same task has already left its archive, keep either (they're equal)."""
    try:
        target.move(own, final)
    except OSError:  # some file systems don't rename onto a file that is there
        if target.get_file_info(final).type != fs.FileType.File:
            raise
        target.delete_file(own)


def _gzip(level: int) -> object:
    return zlib.compressobj(level, zlib.DEFLATED, 31)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One monolithic archive per partition of ``pages (page_id, url, html, digest, refers_to, refers_url)``.

    Returns a row ``archive, records`` for each archive written.  Date and run are set here, so a task
    that runs again writes the same bytes; record ids are made of the run, the partition and the row.
    """
    date, writing = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), uuid.uuid4()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, path = filesystem(folder)
        part = TaskContext.get().partitionId()
        own, name = f"{path}/.{uuid.uuid4().hex}", f"part-{part:05d}.warc.gz"
        count, out, packer = 0, None, _gzip(LEVEL)
        for batch in batches:
            for page_id, url, html, digest, refers_to, refers_url in zip(*(batch.column(i) for i in range(6)), strict=True):
                if out is None:
                    target.create_dir(path, recursive=True)
                    out = target.open_output_stream(own, compression=None)
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                page = Page(page_id.as_py(), url.as_py(), digest.as_py(), refers_to.as_py(), refers_url.as_py())
                out.write(packer.compress(record(page, payload, uuid.uuid5(writing, f"{part}/{count}"), date)))
                count += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            _finish(target, own, f"{path}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["archive", "records"])

    return mapped(pages, run, "archive string, records long")


class _Inflated:
    """Bytes of a gzip file, inflated in bounded pieces, whatever its members."""

    def __init__(self, stream) -> None:
        self.stream, self.inflater, self.held, self.raw = stream, zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        if self.inflater.eof:
            self.raw = self.inflater.unused_data or self.stream.read(PIECE)
            if not self.raw:
                return False
            self.inflater = zlib.decompressobj(31)
        elif self.inflater.unconsumed_tail:
            self.raw = self.inflater.unconsumed_tail
        else:
            self.raw = self.stream.read(PIECE)
            if not self.raw:
                return False
        self.held += self.inflater.decompress(self.raw, PIECE)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise ValueError("a record is cut short")
                return None
        return self._take(at + len(mark))

    def _take(self, size: int) -> bytes:
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes, a piece at a time."""
        while size:
            if not self.held and not self._more():
                raise ValueError("a record is cut short")
            piece = self._take(min(size, len(self.held)))
            size -= len(piece)
            yield piece


def normalise(source: fs.FileSystem, path: str, target_path: str) -> int:
    """Rewrite one archive with a member per record, and its index beside it; returns the records."""
    own = f"{target_path}.{uuid.uuid4().hex}"
    index, offset = bytearray(), 0
    with source.open_input_stream(path, compression=None) as stream, source.open_output_stream(own, compression=None) as out:
        inflated = _Inflated(stream)
        while (head := inflated.until(b"\r\n\r\n")) is not None:
            head = head.lstrip(b"\r\n")
            length = int(parse_header(head)["content-length"])
            member = _gzip(LEVEL)
            size = 0
            for piece in chain([head], inflated.pieces(length + 4)):
                size += out.write(member.compress(piece))
            size += out.write(member.flush())
            index += struct.pack(_INDEX, offset, size)
            offset += size
    with source.open_output_stream(own + ".idx", compression=None) as out:
        out.write(bytes(index))
    _finish(source, own + ".idx", target_path + ".idx")
    _finish(source, own, target_path)
    return len(index) // _ENTRY


#: Tasks of a step at most.
MOST_TASKS = 10_000


def normalise_archives(archives: DataFrame, folder: str, target_folder: str) -> DataFrame:
    """Normalise each row's ``archive`` of ``folder``, a task for each; returns ``archive, records``.

    ``archives`` must be cheap to count, so callers pass a written table.
    """
    dealt = archives.select("archive").repartitionByRange(max(1, min(archives.count(), MOST_TASKS)), "archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, path = filesystem(folder)
        goal = filesystem(target_folder)[1]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                source.create_dir(goal, recursive=True)
                count = normalise(source, f"{path}/{name}", f"{goal}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["archive", "records"])

    return mapped(dealt, run, "archive string, records long")


def read_records(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of normalised archives, by their indexes; ``archives (archive, records)``.

    Each task takes a stretch of at most ``SPLIT`` records.  ``archives`` must be cheap to count.  The digest of a
    response is computed again from its payload; a difference is an error.
    """
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(SPLIT).cast("long")))
    stretches = archives.where("records > 0").select("archive", begins.alias("begin"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    number = lambda field: int(field) if field else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, path = filesystem(folder)
        for batch in batches:
            for name, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with source.open_input_file(f"{path}/{name}.idx") as index:
                    entries = index.read_at(SPLIT * _ENTRY, begin * _ENTRY)
                with source.open_input_file(f"{path}/{name}") as archive:
                    for offset, size in struct.iter_unpack(_INDEX, entries):
                        whole = zlib.decompress(archive.read_at(size, offset), 31)
                        head, _, body = whole.partition(b"\r\n\r\n")
                        fields = parse_header(head)
                        message, _, payload = body[: int(fields["content-length"])].partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        kind = fields["warc-type"]
                        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: the payload at {offset} differs from its digest")
                        rows.append((number(fields["x-page-id"]), int(parse_header(message)["content-length"]), digest, kind,
                                     number(fields.get("x-refers-to-page-id"))) + ((payload,) if with_payload else ()))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                                                 [f.split()[0] for f in schema.split(", ")] + ["payload"] * with_payload)

    number_of = archives.agg(F.sum(F.ceil(F.col("records") / SPLIT))).first()[0] or 0
    dealt = stretches.repartitionByRange(max(1, min(int(number_of), MOST_TASKS)), "archive", "begin")
    return mapped(dealt, run, schema + ", payload binary" * with_payload)


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers_to, refers_url``: refers_to is the response's page_id for revisits.

    Digests that occur more than once are counted with a partial aggregate; they are
    few beside the pages, so pages keep their place if the counted table is small,
    and are joined on the digest, which adaptive execution splits, if not.
    """
    # UTF-8 bytes of the text, so the digest of the payload
    digested = lacking(pages, [("page_id", "long"), ("url", "string"), ("html", "string")]).withColumn(
        "digest", F.sha1(F.coalesce("html", F.lit(""))))
    large = F.octet_length("html") >= MIN_REVISIT
    repeated = written(digested.where(large).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1 and kept.page_id is not null").select("digest", F.col("kept.page_id").alias("kept"), F.col("kept.url").alias("kept_url")), "repeated")
    if (repeated.agg(F.sum(F.lit(160) + F.coalesce(F.octet_length("kept_url"), F.lit(0)))).first()[0] or 0) <= BROADCAST_BYTES:
        repeated = F.broadcast(repeated)
    refers = F.when(large & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return digested.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", refers.alias("refers_to"), F.when(refers.isNotNull(), F.col("kept_url")).alias("refers_url"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise these, and read the records back."""
    spark = pages.sparkSession
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "warc-normalised")
    made = written(write_archives(with_revisits(pages), first), "archives")
    normal = written(normalise_archives(made, first, second), "normalised")
    source, path = filesystem(first)
    if source.get_file_info(path).type == fs.FileType.Directory:
        source.delete_dir(path)  # the monolithic ones aren't needed any more
    return read_records(normal, second)


#: The same in DuckDB's SQL, over the view ``pages``.
ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest AS d, max(page_id) AS kept FROM p WHERE payload_bytes >= {MIN_REVISIT} GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept IS NULL OR kept = page_id THEN NULL ELSE kept END AS refers_to
FROM p LEFT JOIN k ON payload_digest = d AND payload_bytes >= {MIN_REVISIT}
"""
