"""WARC archives: writing pages, normalising whole-file gzip to one member per record, and reading records back.

Archives that some tools write are a single gzip stream over the whole file, in which no record can be read without all before
it. The normaliser inflates such a stream once, front to back, writes every record as a gzip member of its own, and beside the
archive an index of where each member starts. Memory is bounded by the longest record, not by the file.

Files lie in a folder that all executors share. A task writes under a name of its own and reports the name when it is done; what
a lost or repeated attempt has left is named by nobody and is not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, texts
from tallyforge.plans.durable import materialize, new_folder

_DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 20
#: Format of a gzip member for the compressor.
_GZIP = 16 + zlib.MAX_WBITS
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that is given as a path or an address such as ``file:`` or ``hdfs://``."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head, with the length of the payload, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", _DATE),
        ("WARC-Target-URI", json.dumps(url)[1:-1]), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """(head, block, whole record) of each record of an inflated stream that comes in pieces."""
    buffer, at, ended = bytearray(), 0, False

    def need(size: int) -> bool:
        nonlocal ended
        while len(buffer) - at < size and not ended:
            piece = next(pieces, None)
            if piece is None:
                ended = True
            else:
                buffer.extend(piece)
        return len(buffer) - at >= size

    while need(1):
        end = buffer.find(b"\r\n\r\n", at)
        while end < 0:
            if not need(len(buffer) - at + 1):
                raise ValueError("the archive ends within the head of a record")
            end = buffer.find(b"\r\n\r\n", at)
        head = bytes(buffer[at:end])
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        start = end + 4
        size = int(fields_of(head)["content-length"])
        if not need(start - at + size + 4):
            raise ValueError("the archive ends within a record")
        yield head, bytes(buffer[start : start + size]), bytes(buffer[at : start + size + 4])
        at = start + size + 4
        if at > _CHUNK:
            del buffer[:at]
            at = 0


def fields_of(head: bytes) -> dict[str, str]:
    """Fields of a record's head, by name in small letters."""
    pairs = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def inflate(file: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file of one member or many, piece by piece."""
    machine = zlib.decompressobj(_GZIP)
    while data := file.read(_CHUNK):
        while data:
            piece = machine.decompress(data, _CHUNK)
            if piece:
                yield piece
            data = machine.unconsumed_tail
            if machine.eof:
                data = machine.unused_data
                machine = zlib.decompressobj(_GZIP)
    if piece := machine.flush():
        yield piece


def _id_of(value: str | None) -> int | None:
    """The page of a record's name."""
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write rows of (page_id, url, payload, refers_to, revisit) as archives of one gzip stream each; (path, records) of each.

    A partition becomes a file. The rows are streamed, so that no partition has to fit in memory.
    """
    small_batches(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _filesystem(folder)
        file, machine, count = None, zlib.compressobj(1, wbits=_GZIP), 0
        path = f"{place}/whole-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            ids, urls, payloads, refers, revisits = (batch.column(n) for n in range(5))
            for page, url, payload, to, again in zip(
                ids.to_pylist(), urls.to_pylist(), texts(payloads), refers.to_pylist(), revisits.to_pylist(), strict=True
            ):
                if file is None:
                    system.create_dir(place, recursive=True)
                    file = system.open_output_stream(path, compression=None)
                kind = "revisit" if again else "response"
                file.write(machine.compress(record(kind, page, url or "", payload, payload_digest(payload), to)))
                count += 1
        if file is not None:
            file.write(machine.flush())
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "records"])

    columns = records.select("page_id", "url", "payload", "refers_to", "revisit")
    return columns.mapInArrow(run, "path string, records bigint")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with one gzip member per record; (path, index, records) of each new archive.

    The index is a text file of one line per record: offset, length of the member, type, record id and payload digest. The old
    file is deleted by whoever owns it, once the new one is in use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _filesystem(folder)
        system.create_dir(place, recursive=True)
        for batch in batches:
            for old in batch.column(0).to_pylist():
                path, offset, count = f"{place}/records-{uuid.uuid4().hex}.warc.gz", 0, 0
                with (
                    system.open_input_stream(old, compression=None) as source,
                    system.open_output_stream(path, compression=None) as out,
                    system.open_output_stream(f"{path}.idx", compression=None) as index,
                ):
                    for head, _, whole in split_records(inflate(source)):
                        machine = zlib.compressobj(6, wbits=_GZIP)
                        member = machine.compress(whole) + machine.flush()
                        out.write(member)
                        fields = fields_of(head)
                        line = [
                            str(offset), str(len(member)), fields["warc-type"], fields["warc-record-id"], fields["warc-payload-digest"]
                        ]
                        index.write(("\t".join(line) + "\n").encode())
                        offset, count = offset + len(member), count + 1
                columns = [pa.array([path]), pa.array([f"{path}.idx"]), pa.array([count])]
                yield pa.RecordBatch.from_arrays(columns, ["path", "index", "records"])

    return archives.select("path").mapInArrow(run, "path string, index string, records bigint")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, each read by its own index entry.

    The payload of a response is digested anew and held against the digest in its head. A revisit has no payload; its length is
    in the HTTP head.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(folder)
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(path) as file, system.open_input_stream(index, compression=None) as lines:
                    yield from _read(file, lines)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return archives.select("path", "index").mapInArrow(run, schema)


def _read(file: BinaryIO, lines: BinaryIO) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    rest = b""
    while True:
        piece = lines.read(_CHUNK)
        *whole, rest = (rest + piece).split(b"\n")
        for line in whole:
            offset, size = map(int, line.split(b"\t")[:2])
            file.seek(offset)
            head, block, _ = next(split_records(iter([zlib.decompress(file.read(size), _GZIP)])))
            fields = fields_of(head)
            http, _, payload = block.partition(b"\r\n\r\n")
            digest = fields["warc-payload-digest"].removeprefix("sha1:")
            if fields["warc-type"] == "response" and payload_digest(payload) != digest:
                raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
            length = int(fields_of(http)["content-length"])
            refers = _id_of(fields.get("warc-refers-to"))
            rows.append((_id_of(fields["warc-record-id"]), length, digest, fields["warc-type"], refers))
            if len(rows) >= 10_000:
                yield batch()
        if not piece:
            break
    if rows:
        yield batch()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def archive_pages(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): every page, as read back from the archives.

    Pages are written to ``folder`` (a shared one by default), as a record with the HTML in UTF-8 as payload. Of pages with equal
    payloads of at least ``least_bytes`` that with the largest id is a response and others revisit it; smaller ones are
    responses. Equality is that of SHA-1 and length. NULL and empty pages have the empty payload. Rows that repeat both id and
    payload are alike: responses if theirs is the largest id. A row with a NULL id revisits the largest id of its payload, and
    is a response if there is none. An empty table gives an empty result; other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    )
    digests = rows.select("page_id", F.sha1(F.encode("payload", "UTF-8")).alias("digest"), F.octet_length("payload").alias("size"))
    digests = materialize(digests, "warc-digests")
    # Only payloads that more than one id has matter, and of them one small row per digest and per revisit.
    large = digests.where(F.col("size") >= least_bytes)
    keepers = large.groupBy(F.col("digest").alias("_digest"), F.col("size").alias("_size")).agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    keepers = materialize(keepers.where((F.col("n") > 1) & F.col("refers_to").isNotNull()), "warc-keepers")
    same = (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size"))
    revisits = large.join(keepers, same).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = revisits.select(F.col("page_id").alias("_page"), "digest", "refers_to").distinct()
    # Unique by page and digest, so that the pages themselves meet no hot key.
    revisits = materialize(revisits, "warc-revisits")
    keyed = rows.withColumn("_of", F.sha1(F.encode("payload", "UTF-8")))
    joined = keyed.join(revisits, (F.col("_of") == F.col("digest")) & F.col("page_id").eqNullSafe(F.col("_page")), "left")
    records = joined.select("page_id", "url", "payload", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    whole = materialize(write_archives(records, f"{folder}/whole"), "warc-whole")
    files = max(1, whole.count())
    members = materialize(normalise(whole.repartition(files), f"{folder}/records"), "warc-records")
    _delete(spark, f"{folder}/whole")
    return read_archives(members.repartition(files), f"{folder}/records").withColumnRenamed("page_id", id_col)
