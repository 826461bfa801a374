"""WARC archives: writing with revisits, and reading into a table of record chunks.

Archives are gzip files with one member per record. Reading streams each archive: a payload of any
size becomes rows of at most ``CHUNK`` bytes with the record's id, the chunk's number, the bytes up
to there and the SHA-1 of all of them (the first and the last also with the header fields), so no
step of the reader holds a whole record. Digests are the usual bare
upper-case base32.

Scale: to tell responses from revisits, only hashes are grouped, with partial aggregation; payloads
meet the (few) repeated hashes in a join that Spark broadcasts where they are small and splits where
one hash is frequent. Tasks write archives of bounded size, named by attempt; a manifest lists
those that count, so repeated tasks do no harm. An archive is read by one task.

Defined results: NULL html is an empty payload; NULL url writes no target; NULL page id loses to any
other and is read back as NULL. Rows that agree in payload and in the largest id are all responses.
An empty table gives no archive and an empty result. Other columns play no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import filesystem, new_folder, stored

CHUNK = 1 << 16
#: An archive is closed after this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_records bigint, n_bytes bigint"
CHUNKS = (
    "record_id string, chunk_no int, is_last boolean, bytes_so_far bigint, sha1_so_far string, "
    "headers map<string,string>, chunk binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, sha256: str) -> str:
    """The same for the same page and payload, so that a revisit can name its response."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha256}')}>"


def record(kind: str, name: str, fields: dict[str, str | None], content_type: str, block: bytes) -> bytes:
    """One record, not yet compressed."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    lines += [f"{key}: {value}" for key, value in fields.items() if value is not None]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, sha256: str, of: int | None) -> bytes:
    """A response, or with ``of`` (the id of a page with the same payload) a revisit of it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    clean = None if url is None else "".join(c for c in url if c >= " " and c != "\x7f")
    fields = {
        "WARC-Target-URI": clean,
        "WARC-Payload-Digest": f"sha1:{base32(hashlib.sha1(payload).digest())}",
        "X-Page-Id": None if page_id is None else str(page_id),
    }
    if of is None:
        block = http.encode() + payload
        return record("response", record_id(page_id, sha256), fields, "application/http;msgtype=response", block)
    fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(of, sha256)}
    name = f"<urn:uuid:{uuid.uuid4()}>"
    return record("revisit", name, fields, "application/http;msgtype=response", http.encode())


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``sha`` and ``of``: for a revisit, the largest page id with the same payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("sha"))
    repeated = (
        hashed.where(F.octet_length("html") >= min_bytes)
        .groupBy(F.col("sha").alias("same"))
        .agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
        .where("n > 1 AND top IS NOT NULL")
    )
    joined = hashed.join(stored(repeated, "payloads"), F.col("sha") == F.col("same"), "left")
    of = F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return joined.select("page_id", "url", "html", "sha", of.alias("of"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html`` as records; the manifest, one row per archive, stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        done, out = [], None

        def close():
            out.close()
            done.append((f"{folder}/{name}", records, written))

        for batch in batches:
            for row in zip(*batch.columns):
                page_id, url, html, sha, of = row
                if out is None:
                    fs.create_dir(root, recursive=True)
                    part = TaskContext.get().partitionId()
                    name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
                    out, records, written = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                    about = f"software: tillflow\r\nformat: WARC File Format 1.1\r\npart: {part}\r\n".encode()
                    info = record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", {}, "application/warc-fields", about)
                    written += out.write(gzip.compress(info, 3, mtime=0)) or 0
                made = page_record(
                    page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), sha.as_py(), of.as_py()
                )
                member = gzip.compress(made, 3, mtime=0)
                out.write(member)
                records, written = records + 1, written + len(member)
                if written >= size:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            columns = zip(*done)
            types = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["path", "n_records", "n_bytes"]
            )

    rows = with_responses(pages, min_bytes).withColumn("page_id", F.col("page_id").cast("bigint"))
    return stored(rows.mapInArrow(write, MANIFEST), "archives")


class Records:
    """Streams the records of an archive; ``source`` needs ``read(n)``.

    Bytes are expanded a little at a time; nothing longer than a header block is kept.
    """

    def __init__(self, source, step: int = CHUNK):
        self.source, self.step = source, step
        self.expander, self.packed, self.plain = None, b"", bytearray()

    def _more(self) -> bool:
        while True:
            if self.expander is None or self.expander.eof:
                self.packed = (self.expander.unused_data if self.expander else b"") or self.packed
                self.packed = self.packed or self.source.read(self.step)
                if not self.packed:
                    return False
                self.expander = zlib.decompressobj(wbits=31)
            data = self.packed or self.source.read(self.step)
            if not data:
                raise EOFError("the archive ends inside a record")
            made = self.expander.decompress(data, self.step)
            self.packed = self.expander.unconsumed_tail
            if made:
                self.plain += made
                return True

    def _upto(self, mark: bytes) -> bytes | None:
        at = self.plain.find(mark)
        while at < 0:
            seen = max(0, len(self.plain) - len(mark) + 1)
            if not self._more():
                return None
            at = self.plain.find(mark, seen)
        found = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return found

    def _bytes(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.plain and not self._more():
                raise EOFError("the archive ends inside a record")
            part = bytes(self.plain[: min(count, self.step)])
            del self.plain[: len(part)]
            count -= len(part)
            yield part

    def __iter__(self) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
        """Header fields (lower-case names) and the parts of the block, to be read in order."""
        while True:
            self.plain = self.plain.lstrip(b"\r\n")
            if not self.plain:
                if not self._more():
                    return
                continue
            head = self._upto(b"\r\n\r\n")
            if head is None:
                raise EOFError("the archive ends inside a header block")
            lines = head.decode("utf-8", "replace").split("\r\n")
            fields = {}
            for line in lines[1:]:
                key, _, value = line.partition(":")
                fields[key.strip().lower()] = value.strip()
            length = int(fields.get("content-length", "0"))
            parts = self._bytes(length)
            if "application/http" in fields.get("content-type", ""):
                http = bytearray()
                while b"\r\n\r\n" not in http and (part := next(parts, None)) is not None:
                    http += part
                _, _, rest = bytes(http).partition(b"\r\n\r\n")
                body = (part for source in ([rest] if rest else [], parts) for part in source)
            else:
                body = parts
            yield fields, body
            for _ in body:  # what the caller has left
                pass


def chunks(fields: dict[str, str], body: Iterator[bytes], size: int = CHUNK) -> Iterator[tuple]:
    """The rows of one record; a record without payload has one row."""
    sha, total, number, held = hashlib.sha1(), 0, 0, bytearray()
    name = fields.get("warc-record-id")

    def row(data: bytes, last: bool):
        nonlocal total, number
        sha.update(data)
        total += len(data)
        made = (name, number, last, total, base32(sha.copy().digest()), fields if last or number == 0 else None, data)
        number += 1
        return made

    for part in body:
        held += part
        while len(held) > size:  # the last chunk is kept back, to be marked as such
            yield row(bytes(held[:size]), False)
            del held[:size]
    yield row(bytes(held), True)


def read_chunks(manifest: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunk table of the archives listed in ``path``: see ``CHUNKS``."""
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("chunk_no", pa.int32()),
            ("is_last", pa.bool_()),
            ("bytes_so_far", pa.int64()),
            ("sha1_so_far", pa.string()),
            ("headers", pa.map_(pa.string(), pa.string())),
            ("chunk", pa.binary()),
        ]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        columns[5] = [None if f is None else list(f.items()) for f in columns[5]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = filesystem(path)
                with fs.open_input_stream(place, compression=None) as source:
                    for fields, body in Records(source):
                        for row in chunks(fields, body, size):
                            rows.append(row)
                            held += len(row[-1]) + 200
                            if held >= 16 * size:
                                yield batch_of(rows)
                                rows, held = [], 0
        if rows:
            yield batch_of(rows)

    count = max(1, manifest.count())
    return manifest.select("path").repartition(count).mapInArrow(read, CHUNKS)


def page_digests(table: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page record.

    The length and digest of a response are those of its last chunk; a revisit has those of the
    response it names.
    """
    headers = F.col("headers")
    ends = table.where("is_last").select(
        "record_id",
        headers["warc-type"].alias("record_type"),
        headers["x-page-id"].cast("bigint").alias("page_id"),
        headers["warc-refers-to"].alias("refers"),
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("sha1_so_far").alias("payload_digest"),
    )
    ends = stored(ends.where("record_type IN ('response', 'revisit')"), "records")
    revisits, responses = ends.where("record_type = 'revisit'"), ends.where("record_type = 'response'")
    named = responses.groupBy(F.col("record_id").alias("named")).agg(
        F.max("page_id").alias("refers_to"),
        F.max("payload_bytes").alias("payload_bytes"),
        F.max("payload_digest").alias("payload_digest"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = revisits.drop("payload_bytes", "payload_digest").join(
        stored(named, "responses"), F.col("refers") == F.col("named"), "left"
    )
    own = responses.withColumn("refers_to", F.lit(None).cast("bigint"))
    return own.select(columns).unionByName(found.select(columns))


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write every page to archives in the shared folder and read them back."""
    manifest = write_archives(pages, new_folder(spark, "warc"), min_bytes)
    return page_digests(read_chunks(manifest))
