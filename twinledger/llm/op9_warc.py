"""WARC archives written from and read into a chunked record table.

A record is rows (record, chunk number, bytes), so a long payload never has to be held whole: the
writer streams chunk rows into gzip members, the reader turns archives back into chunk rows that carry
the number of bytes so far and the SHA-1 so far. The last chunk of a record has its whole digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.operators.balance import written
from twinledger.session import scratch_path

CHUNK_BYTES = 64 << 10
#: A new archive file is begun after so many compressed bytes.
FILE_BYTES = 256 << 20
#: Archives are dealt to at most so many tasks; a task reads its archives one after the other.
READ_TASKS = 10_000
_BUFFER = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def filesystem(uri: str):
    """(file system, path) for a folder that all executors share; any scheme that Arrow knows."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32(hexadecimal: Column) -> Column:
    """Base32 of a hexadecimal string of 40 digits, eight characters for ten digits."""
    def digit(block: Column, i: int) -> Column:
        return F.substring(F.lit(_DIGITS), (F.shiftright(block, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1))

    parts = []
    for k in range(4):
        block = F.conv(F.substring(hexadecimal, 10 * k + 1, 10), 16, 10).cast("bigint")
        parts += [digit(block, i) for i in range(8)]
    return F.concat(*parts)


def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                  min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload_bytes``, ``payload_digest`` and ``refers_to``.

    Of equal payloads of at least ``min_bytes`` the one with the smallest id is stored, the others refer
    to it. Only ids and digests are grouped, and only repeated payloads are joined.
    """
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    marked = pages.withColumns({"payload_bytes": F.octet_length(body).cast("bigint"), "_sha1": F.sha1(body)})
    narrow = marked.where((F.col("payload_bytes") >= min_bytes) & F.col(id_col).isNotNull()).select(id_col, "_sha1")
    repeated = (
        narrow.groupBy("_sha1").agg(F.min(id_col).alias("_first"), F.max(id_col).alias("_last"))
        .where(F.col("_first") < F.col("_last")).select("_sha1", "_first")
    )
    later = narrow.join(repeated, "_sha1").where(F.col(id_col) > F.col("_first")).groupBy(id_col, "_sha1").agg(
        F.min("_first").alias("refers_to"))
    return marked.join(later, [id_col, "_sha1"], "left").withColumn("payload_digest", base32(F.col("_sha1"))).drop("_sha1")


def chunk_rows(records: DataFrame, payload_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each chunk of each payload, in order: ``chunk_no``, ``data`` instead of the payload.

    An empty or null payload has one empty chunk; so has a record that refers to another.
    """
    body = F.encode(F.when(F.col("refers_to").isNull(), F.coalesce(F.col(payload_col), F.lit(""))).otherwise(""), "UTF-8")
    others = [c for c in records.columns if c != payload_col]
    held = records.select(*others, F.explode(F.array(body)).alias("_body"))
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.octet_length("_body") - 1) / chunk_bytes).cast("int")))
    return held.select(*others, "_body", F.explode(numbers).alias("chunk_no")).select(
        *others, "chunk_no", F.substring(F.col("_body"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))


def _head(record_type: str, record_id: str, url: str | None, length: int, digest: str, refers_to: str | None) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{record_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z",
             "WARC-Target-URI: " + " ".join((url or "urn:page:" + record_id).split()),
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: text/html", f"Content-Length: {length}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join([*lines, "", ""]).encode()


class _Archive:
    """One archive file: a gzip member a record, fed chunk by chunk."""

    def __init__(self, folder: str):
        # a name of its own for each attempt: a task that is run again never meets its old files
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        self.path, self.out = f"{folder}/{name}", fs.open_output_stream(f"{path}/{name}", compression=None)
        self.member, self.records, self.bytes = None, 0, 0

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        if data:
            self.out.write(data)

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.records += 1
        self._put(self.member.compress(head))

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.member = None

    def close(self) -> tuple[str, int]:
        self.out.close()
        return self.path, self.records


def write_archives(records: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``records`` (see ``with_revisits``) and return ``path, n_records``
    of the files of the attempts that succeeded. An empty table has no files.

    The list is written beside the archives, so files of attempts that failed are never read.
    """
    spark = records.sparkSession
    chunked = chunk_rows(records.select(id_col, url_col, payload_col, "payload_bytes", "payload_digest", "refers_to"),
                         payload_col).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(url_col).cast("string").alias("url"),
        "payload_bytes", "payload_digest", F.col("refers_to").cast("string").alias("refers_to"), "chunk_no", "data")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for id_, url, length, digest, refers_to, chunk_no, data in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk_no == 0:
                    if archive and archive.member:
                        archive.end()
                    if archive and archive.bytes >= file_bytes:
                        done.append(archive.close())
                        archive = None
                    archive = archive or _Archive(folder)
                    kind = "response" if refers_to is None else "revisit"
                    archive.begin(_head(kind, id_, url, length if refers_to is None else 0, digest, refers_to))
                archive.add(data)
        if archive:
            archive.end()
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"])

    chunked.mapInArrow(write, "path string, n_records bigint").write.parquet(f"{folder}/_files")
    return spark.read.parquet(f"{folder}/_files")


class _Reader:
    """Uncompressed bytes of a file of gzip members (or of plain records), a buffer at a time."""

    def __init__(self, path: str):
        fs, inner = filesystem(path)
        self.file = fs.open_input_stream(inner, compression=None, buffer_size=_BUFFER)
        self.left, self.packed, self.member = b"", b"", None
        self.gzip = None

    def _more(self) -> bool:
        while True:
            if not self.packed:
                self.packed = self.file.read(_BUFFER)
                if not self.packed:
                    return False
                if self.gzip is None:
                    self.gzip = self.packed[:2] == b"\x1f\x8b"
            if not self.gzip:
                self.left, self.packed = self.left + self.packed, b""
                return True
            self.member = self.member or zlib.decompressobj(31)
            got = self.member.decompress(self.packed, _BUFFER)
            self.packed = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = None
            if got:
                self.left += got
                return True

    def line(self) -> bytes | None:
        while b"\n" not in self.left:
            if not self._more():
                out, self.left = self.left, b""
                return out or None
        out, _, self.left = self.left.partition(b"\n")
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        """Some of the next n bytes, at least one."""
        if not self.left and not self._more():
            raise EOFError("the archive ends inside a record")
        out, self.left = self.left[:n], self.left[n:]
        return out


def _records(path: str, chunk_bytes: int) -> Iterator[tuple]:
    source = _Reader(path)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: a record does not begin with its version")
        head = {}
        while line := source.line():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        length, state, done, number, held = int(head["content-length"]), hashlib.sha1(), 0, 0, b""
        refers = head.get("warc-refers-to")
        about = (head["warc-record-id"], head.get("warc-target-uri"), head["warc-type"],
                 head.get("warc-payload-digest", "").removeprefix("sha1:"), refers)
        while True:
            while len(held) < chunk_bytes and done + len(held) < length:
                held += source.take(min(chunk_bytes - len(held), length - done - len(held)))
            state.update(held)
            done += len(held)
            yield (*about, number, held, done, base64.b32encode(state.copy().digest()).decode(), done == length)
            if done == length:
                break
            number, held = number + 1, b""


CHUNK_SCHEMA = pa.schema({
    "record_id": pa.string(), "url": pa.string(), "record_type": pa.string(), "stated_digest": pa.string(),
    "refers_to": pa.string(), "chunk_no": pa.int32(), "data": pa.binary(), "bytes_so_far": pa.int64(),
    "digest_so_far": pa.string(), "is_last": pa.bool_()})
CHUNK_DDL = ("record_id string, url string, record_type string, stated_digest string, refers_to string, "
             "chunk_no int, data binary, bytes_so_far bigint, digest_so_far string, is_last boolean")


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, batch_bytes: int = 4 << 20,
                  with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives in ``path``: CHUNK_DDL. A file is read by one task, as a stream.

    ``with_data=False`` leaves ``data`` null for callers that need counts and digests only.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in _records(path, chunk_bytes):
                    held += len(row[6]) + 200
                    rows.append(row if with_data else (*row[:6], None, *row[7:]))
                    if held >= batch_bytes:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNK_SCHEMA)], schema=CHUNK_SCHEMA)

    paths = files.select("path").distinct()
    # a stated number of partitions is not merged by the size of the names, which says nothing of the archives'
    spread = paths.repartition(min(max(1, paths.count()), READ_TASKS), "path")  # a file a row, dealt over the tasks
    return spread.mapInArrow(read, CHUNK_DDL)


def records_of(chunks: DataFrame) -> DataFrame:
    """A row for each record: ``record_id, payload_bytes, payload_digest, record_type, refers_to, intact``.

    The last chunk of a response has its size and digest. A revisit has no payload; it takes both from
    the response that it refers to. ``intact`` tells that the stated digest is the one found, or for a
    revisit that there is such a response; else its size and digest are null. The archives are read once:
    last chunks are stored without their data.
    """
    last = written(chunks.where("is_last").drop("data", "chunk_no", "url"), "records")
    name = lambda c: F.regexp_extract(c, "<urn:page:(.*)>", 1)
    responses = last.where("record_type = 'response'").select(
        name("record_id").alias("record_id"), F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"), "record_type", F.lit(None).cast("string").alias("refers_to"),
        (F.col("digest_so_far") == F.col("stated_digest")).alias("intact"))
    revisits = last.where("record_type = 'revisit'").select(
        name("record_id").alias("record_id"), "record_type", name("refers_to").alias("refers_to"), "stated_digest")
    found = responses.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest",
                             F.col("payload_digest").alias("stated_digest")).dropDuplicates(["refers_to", "stated_digest"])
    return responses.unionByName(
        revisits.join(found, ["refers_to", "stated_digest"], "left")
        .withColumn("intact", F.col("payload_digest").isNotNull()).drop("stated_digest"))


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` (a scratch folder by default) and return their file list.

    Null payloads are empty ones. Rows are told apart by id: of repeated rows with one id every copy is
    a record, and none refers to another of the same id. A null id is written as an empty record name.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_archives(with_revisits(pages, id_col, payload_col, min_bytes), folder, id_col, url_col, payload_col)


def sql() -> str:
    """The rows of the query over ``pages``, as DuckDB SQL."""
    return f"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
blocks AS (
    SELECT page_id, n, list_transform(range(4), lambda k: list_reduce(list_transform(range(10),
        lambda i: CAST(strpos('0123456789ABCDEF', substr(hex, CAST(10 * k + i + 1 AS BIGINT), 1)) - 1 AS BIGINT)),
        lambda x, y: x * 16 + y)) AS b FROM payloads),
digests AS (
    SELECT page_id, n, array_to_string(list_transform(range(32), lambda i:
        substr('{_DIGITS}', ((b[i // 8 + 1] >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) + 1, 1)), '') AS d FROM blocks),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM digests)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to
FROM firsts"""
