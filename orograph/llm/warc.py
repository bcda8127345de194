"""Web archives as a chunked record table.

Payloads become rows (record, chunk number, bytes), so that no step but the source holds a whole payload.
Chunks stream into WARC files (one gzip member for each record) with digests carried from chunk to chunk, and stream back out
as chunk rows again. Of records with equal payloads of at least REVISIT bytes the one of the largest id is a response and the others
are revisits that name it. A record's name is its page id and its payload's digest, and a revisit says the digest of the
payload it stands for, so rows of one id with other payloads keep theirs. Files are written in the shared folder by Arrow's
file systems; a file counts only if its task's manifest row was stored, so a lost or repeated task leaves nothing that is read.

Defined results: a null html is an empty payload. Rows that repeat the largest id of a payload are responses
all of them. A null page_id stands as an empty id, is the smallest, and comes back as null. An empty table
gives no files and no records. Columns besides page_id, url and html are not read; a null url is empty.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, lean, shared_dir, stored, table

CHUNK = 1 << 18
REVISIT = 1000
BROADCAST_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _body(html: Column) -> Column:
    return F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))


def record_types(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of every revisit; all other rows are responses."""
    body = _body(F.col("html"))
    sizes = stored(pages.select("page_id", F.octet_length(body).alias("n"), F.sha1(body).alias("digest")).where(F.col("n") >= REVISIT), "digests")
    last = sizes.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("k")).where("k > 1")
    return sizes.join(last, ["digest", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def chunks(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The record table: for each row its record's type, its payload's digest and the payload in chunk rows, in order; a
    revisit has one empty chunk. A chunk row holds its chunk only."""
    kinds = stored(record_types(pages).withColumnRenamed("page_id", "__id").withColumnRenamed("digest", "__digest"), "revisits")
    if kinds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        kinds = F.broadcast(kinds)  # else both sides are shuffled by page and digest
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), _body(F.col("html")).alias("body")).withColumn("digest", F.sha1("body"))
    joined = own.join(kinds, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    again = F.col("refers_to").isNotNull()
    body = F.when(again, F.lit(b"")).otherwise(F.col("body"))
    rows = joined.select("page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"), "refers_to", "digest", body.alias("body"))
    rows = rows.withColumn("payload_bytes", F.octet_length("body").cast("long"))  # before the chunks, so that the payload itself goes no further
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("body") / chunk) - 1).cast("int"))
    slices = F.transform(numbers, lambda k: F.substring(F.col("body"), k * chunk + 1, F.lit(chunk)))
    return rows.select("page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", F.posexplode(slices).alias("chunk", "data"))


def _name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def _header(page_id: int | None, url: str, kind: str, refers_to: int | None, digest: str, length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id, digest)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join(url.split())}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_name(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode("utf-8", "replace")


class RecordWriter:
    """Writes records to a stream as their chunks come, each record its own gzip member."""

    def __init__(self, out) -> None:
        self.out, self.records, self.member, self.left = out, 0, None, 0

    def chunk(self, page_id: int | None, url: str, kind: str, refers_to: int | None, digest: str, length: int, number: int, data: bytes) -> None:
        if number == 0:
            self.close_record()
            self.member, self.left = zlib.compressobj(1, zlib.DEFLATED, 31), length
            self.records += 1
            self.out.write(self.member.compress(_header(page_id, url, kind, refers_to, digest, length)))
        self.left -= len(data)
        self.out.write(self.member.compress(data))

    def close_record(self) -> None:
        if self.member is not None:
            if self.left:
                raise ValueError("a record's chunks don't add up to its length")
            self.out.write(self.member.compress(b"\r\n\r\n") + self.member.flush())
            self.member = None


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def written(rows: DataFrame, folder: str) -> DataFrame:
    """Writes a record table to WARC files below folder; path and number of records of each file that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        path, out = f"{base}/{uuid.uuid4().hex}.warc.gz", None
        for batch in batches:
            if out is None and batch.num_rows:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(path, compression=None)
                writer = RecordWriter(out)
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                writer.chunk(*row)
        if out is not None:
            writer.close_record()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([writer.records], pa.int64())], ["path", "records"])

    bounded_batches(rows.sparkSession)
    return stored(rows.mapInArrow(lean(run), "path string, records long"), "manifest")


class RecordReader:
    """Reads records from a stream of gzip members without holding more than a block of it."""

    def __init__(self, source, block: int = 1 << 16) -> None:
        self.source, self.block = source, block
        self.raw, self.plain, self.member = b"", b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self.member.eof:
                self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(self.block)
                if not self.raw:
                    return False
            got = self.member.decompress(self.raw, self.block)
            self.raw = b"" if self.member.eof else self.member.unconsumed_tail
            if got:
                self.plain += got
                return True

    def records(self) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
        """Each record's header fields and its payload piece by piece; pieces are read before the next record."""
        while True:
            while b"\r\n\r\n" not in self.plain:
                if not self._more():
                    if self.plain.strip():
                        raise ValueError("the archive ends within a record")
                    return
            head, _, self.plain = self.plain.partition(b"\r\n\r\n")
            lines = head.decode("utf-8").split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError("no record begins here")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            yield fields, self._payload(int(fields["Content-Length"]))
            self._take(4)

    def _payload(self, left: int) -> Iterator[bytes]:
        while left:
            if not self.plain and not self._more():
                raise ValueError("the archive ends within a record")
            piece, self.plain = self.plain[:left], self.plain[left:]
            left -= len(piece)
            yield piece

    def _take(self, n: int) -> None:
        if b"".join(self._payload(n)) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def _number(field: str | None) -> int | None:
    text = (field or "").removeprefix("<urn:page:").partition(":")[0]
    return int(text) if text else None


_READ = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("said", pa.string()),
    ("chunk", pa.int32()), ("n", pa.int64()), ("digest", pa.string()), ("last", pa.bool_()),
]


def read_chunks(manifest: DataFrame, folder: str, ends_only: bool = False) -> DataFrame:
    """The record table of the files in manifest: the digest that each record's header says, and the running length and SHA-1
    of what was read up to each chunk (ends_only: up to the last). A response whose payload has another digest is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _filesystem(folder)
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _READ)], [n for n, _ in _READ])
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, seen = [], 0
                with files.open_input_stream(path, compression=None) as source:
                    for fields, payload in RecordReader(source).records():
                        seen += 1
                        said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        key = (_number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], _number(fields.get("WARC-Refers-To")), said)
                        digest, done, length = hashlib.sha1(), 0, int(fields["Content-Length"])
                        for number, piece in enumerate(payload if length else [b""]):
                            digest.update(piece)
                            done += len(piece)
                            if done == length or not ends_only:
                                rows.append((*key, number, done, digest.hexdigest(), done == length))
                        if key[2] == "response" and digest.hexdigest() != said:
                            raise ValueError(f"a payload in {path} isn't that of its header")
                        if len(rows) >= 2000:
                            yield batch_of(rows)
                            rows = []
                if seen != expected:
                    raise ValueError(f"{path} has {seen} records, not {expected}")
                if rows:
                    yield batch_of(rows)

    spread = manifest.repartition(max(1, min(10_000, manifest.count())), "path")
    return spread.mapInArrow(lean(run), "page_id long, url string, record_type string, refers_to long, said string, chunk int, n long, digest string, last boolean")


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes all pages to WARC files in a new folder of the shared one; the files' manifest and that folder."""
    folder = folder or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return written(chunks(pages), folder), folder


def records(manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each record read back: a revisit has the digest it says and the length of the response that has it."""
    ends = stored(read_chunks(manifest, folder, ends_only=True).where("last"), "records")
    responses = ends.where("record_type = 'response'").select("page_id", "url", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    named = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = ends.where("record_type = 'revisit'").select("page_id", "url", F.col("said").alias("payload_digest"), "record_type", "refers_to")
    named = named.join(revisits.select("refers_to", "payload_digest").distinct(), ["refers_to", "payload_digest"], "left_semi")
    full = revisits.join(named, ["refers_to", "payload_digest"])
    return responses.unionByName(full.select(*responses.columns))


def op5_chunked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = archive(table(spark, sf_dir, "pages"))
    return records(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM q
"""
