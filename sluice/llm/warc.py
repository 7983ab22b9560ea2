"""WARC archives: monolithic gzip files, their normal form with one member per record, and an offset index.

``write_archives`` writes plain WARC files, each one gzip stream, as careless
tools leave them. ``normalise`` inflates each such file once, rewrites every
record as a gzip member of its own and writes a sidecar index of offsets
beside it. ``read_records`` then reaches each record by its offset alone.

Files go through the file system that their URI names, in tasks, as streams:
a task holds one record at a time. Files are written under an attempt's own
name and moved into place, so a repeated task leaves one complete file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, small_or_shuffled, table

# Payloads of at least so many bytes are written once; later equal ones become revisits.
REVISIT_BYTES = 0
GZIP_LEVEL = 1
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, record_no long, record_id string, record_type string, target_uri string, payload_digest string, offset long, length long"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 bits, ten hexadecimal digits, become eight digits at a time."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def planned_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of each page.

    Of equal payloads of at least ``least`` bytes the one with the largest
    page_id is the response. Null html is an empty payload. Rows that repeat
    that page_id are all responses; a null page_id is a revisit if its
    payload has a response, and a response without one.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    size = F.octet_length("payload").cast("long")
    seen = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": size, "payload_digest": base32_sha1(F.col("payload"))}
    )
    heads = (
        seen.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and head is not null")
        .select("payload_digest", "head")
    )
    both = seen.join(small_or_shuffled(heads), "payload_digest", "left")
    revisit = F.coalesce(F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")), F.lit(False)) & (F.col("payload_bytes") >= least)
    return both.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("head")).alias("refers_to"),
    )


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def clean(value) -> str:
    """A header's value in one line."""
    return " ".join(str(value).split())


def record_bytes(row: dict) -> bytes:
    """One WARC record; the payload follows an HTTP head, a revisit has the head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (row["payload"] if row["record_type"] == "response" else b"")
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(row["page_id"]),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": clean(row["url"] or f"urn:page:{row['page_id']}"),
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
        "X-Page-ID": "" if row["page_id"] is None else str(row["page_id"]),
        "X-Payload-Length": str(row["payload_bytes"]),
    }
    if row["record_type"] == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(row["refers_to"]), "X-Refers-To-Page": str(row["refers_to"])}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items()), "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def place(uri: str):
    """File system and path of a URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else fs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))


class Written:
    """A file written under a name of its own and moved into place at the end."""

    def __init__(self, uri: str):
        self.fs, self.path = place(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def done(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def write_archives(records: DataFrame, folder: str, level: int = GZIP_LEVEL) -> DataFrame:
    """Write the records of each partition as one gzip stream in one file; returns archive (its URI) and n_records."""

    def write(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        out, n = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz"
                    out, pack = Written(name), zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(pack.compress(record_bytes(row)))
                n += 1
        if out is not None:
            out.write(pack.flush())
            out.done()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "n_records"])

    return records.mapInArrow(write, "archive string, n_records long")


def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """Plain bytes of a gzip stream of one or many members; other data is passed on as it is."""
    import zlib

    data = stream.read(chunk)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = stream.read(chunk)
        return
    unpack = zlib.decompressobj(31)
    while data:
        while data:
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            plain = unpack.decompress(data, 4 * chunk)
            if plain:
                yield plain
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            if unpack.eof and not data.strip(b"\0"):
                break
        data = stream.read(chunk)
    if not unpack.eof:
        raise EOFError("the gzip stream ends inside a member")


def headers(head: bytes) -> dict[str, str]:
    """Names in lower case and values of a record's head."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record of a plain WARC byte stream."""
    buf = bytearray()

    def more() -> bool:
        for data in chunks:
            buf.extend(data)
            return True
        return False

    while True:
        seen = 0
        while (at := buf.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(buf) - 3)
            if not more():
                if buf.strip():
                    raise EOFError("the archive ends inside a record's head")
                return
        found = headers(bytes(buf[:at]))
        end = at + 4 + int(found["content-length"]) + 4
        while len(buf) < end:
            if not more():
                raise EOFError("the archive ends inside a record")
        yield found, bytes(buf[:end])
        del buf[:end]


def normalise(archives: DataFrame, folder: str, level: int = GZIP_LEVEL) -> DataFrame:
    """Rewrite each file of ``archives`` (archive: its URI) into ``folder``, one gzip member per record.

    Returns the index, a row per record: the new file, the record's number,
    identity, type, target, payload digest, and offset and length of its
    member. The same rows lie beside each file as ``<file>.index.tsv``. Whole
    gzip streams, files of many members and plain files are read alike; a
    truncated file is an error.
    """

    def rewrite(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        schema = pa.schema([(f, pa.int64() if kind == "long" else pa.string()) for f, kind in (x.split() for x in INDEX.split(", "))])
        for batch in batches:
            for source in batch.column(0).to_pylist():
                fs, path = place(source)
                target = f"{folder}/{source.rpartition('/')[2]}"
                out, index, offset, rows = Written(target), Written(f"{target}.index.tsv"), 0, []
                with fs.open_input_stream(path, compression=None) as stream:
                    for n, (head, record) in enumerate(records_of(inflated(stream))):
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        named = [head.get(k, "") for k in ("warc-record-id", "warc-type", "warc-target-uri", "warc-payload-digest")]
                        row = (target, n, *named, offset, len(member))
                        index.write(("\t".join(clean(x) for x in row[1:]) + "\n").encode())
                        rows.append(row)
                        offset += len(member)
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                out.done()
                index.done()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return archives.select("archive").mapInArrow(rewrite, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """Fetch each record of ``index`` by its offset: its header fields, its payload (null for revisits) and the payload's own digest."""
    fields = ("page", "payload_length", "digest", "record_type", "refers_to")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields] + [T.StructField("payload", T.BinaryType())])

    def fetch(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        opened: tuple = (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols: list[list] = [[] for _ in range(6)]
                for archive, offset, length in zip(*(part.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                    if opened[0] != archive:
                        if opened[1] is not None:
                            opened[1].close()
                        fs, path = place(archive)
                        opened = (archive, fs.open_input_file(path))
                    record = zlib.decompress(opened[1].read_at(length, offset), 31)
                    head, _, block = record.partition(b"\r\n\r\n")
                    found = headers(head)
                    payload = block[: int(found["content-length"])].partition(b"\r\n\r\n")[2] if found["warc-type"] == "response" else None
                    row = [found.get("x-page-id"), found.get("x-payload-length"), found.get("warc-payload-digest", "").removeprefix("sha1:")]
                    for c, v in zip(cols, (*row, found["warc-type"], found.get("x-refers-to-page"), payload), strict=True):
                        c.append(v)
                kinds = [pa.string()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

    return index.select("archive", "offset", "length").mapInArrow(fetch, schema)


def round_trip(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read every record back by its offset.

    One row per page: page_id, payload_bytes, payload_digest (from the bytes
    read for responses), record_type, refers_to. Empty pages give no rows;
    other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    root = scratch.root
    archives = scratch.write(write_archives(planned_records(pages, least), f"{root}/whole"), "archives")
    # one file is one unit of work, so files are dealt out one by one
    spread = archives.repartition(max(1, min(archives.count(), 4 * spark.sparkContext.defaultParallelism)), "archive")
    index = scratch.write(normalise(spread, f"{root}/members"), "index")
    id_type = pages.schema["page_id"].dataType
    read = read_records(index)
    is_response = F.col("record_type") == "response"
    return read.select(
        F.nullif("page", F.lit("")).cast(id_type).alias("page_id"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length").cast("long")).alias("payload_bytes"),
        F.when(is_response, base32_sha1(F.col("payload"))).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((
      (CAST('0x' || substr(hex, CAST(i // 8 * 10 + 1 AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = max(page_id) OVER (PARTITION BY payload_digest) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER (PARTITION BY payload_digest) THEN max(page_id) OVER (PARTITION BY payload_digest) END AS refers_to
FROM d
"""
