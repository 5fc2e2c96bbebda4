"""WARC archives: written as whole-file gzip, normalised to one member per record with an index.

Many crawlers compress a whole archive as one gzip stream, which can only be read from its start.
The normaliser inflates such a file once, in pieces, writes every record as a gzip member of its own
and a sidecar row (file, offset, length, record id), so that any record is read with one seek. A
file is one task; a task holds one record at a time. Output files are written under a name of the
attempt and then renamed, so a repeated task replaces its file by an equal one.

Files are reached through pyarrow's file systems, so the folder may be local, HDFS or an object store.

A revisit record carries no payload but the digest and size of the payload it repeats, and the id of
the record that holds it.

Defined cases: a null payload is empty; rows of one id with equal payloads are all responses; a null
id is archived without one and comes back as null; an empty table makes no record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldgap.session import scratch_path

GZIP = 16 + zlib.MAX_WBITS
PIECE = 1 << 20
END = b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Records that share one file when archives are written.
RECORDS_PER_FILE = 5000
#: Index rows of one file that one task reads back.
READ_TOGETHER = 500

INDEX = "file string, offset long, length long, record long, record_id string"
RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 5 hex digits are 4 characters."""
    hexed = F.sha1(payload)

    def characters(group: int) -> list[Column]:
        value = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(BASE32), F.shiftright(value, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)) for i in range(4)]

    return F.concat(*[c for group in range(8) for c in characters(group)])


def with_revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add record type and reference to (id, uri, payload): of equal payloads the largest id is the response.

    Digests are counted first with map-side combining; a payload that a third of the rows share is one
    row per task there, and the join back may split it.
    """
    sized = rows.withColumn("payload", F.coalesce("payload", F.lit(""))).withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
    sized = sized.withColumn("bytes", F.octet_length("payload").cast("long"))
    shared = (
        sized.where(F.col("bytes") >= least_bytes)
        .groupBy("digest").agg(F.max("id").alias("held_by"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    joined = sized.join(shared, "digest", "left")
    again = F.col("held_by").isNotNull() & ~F.col("held_by").eqNullSafe(F.col("id")) & (F.col("bytes") >= least_bytes)
    return joined.select(
        "id", "uri", "payload", "digest", "bytes", F.when(again, F.col("held_by")).alias("refers_to")
    )


def record_text(id_: Column, uri: Column, payload: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """A record up to the last line feed of its end, which the text writer adds."""

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    revisit = refers_to.isNotNull()
    one_line = F.regexp_replace(uri, "[\\r\\n]", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.coalesce(header("WARC-Record-ID", F.concat(F.lit("<urn:record:"), id_.cast("string"), F.lit(">"))), F.lit("")),
        F.coalesce(header("WARC-Target-URI", one_line), F.lit("")),
        F.coalesce(header("WARC-Refers-To", F.concat(F.lit("<urn:record:"), refers_to.cast("string"), F.lit(">"))), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        header("WARC-Payload-Length", size.cast("string")),
        header("Content-Length", F.when(revisit, F.lit(0)).otherwise(size).cast("string")),
        F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(payload),
        F.lit("\r\n\r"),
    )


def write_monolithic(records: DataFrame, folder: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of one gzip stream each, by Spark's own text writer."""
    body = record_text(*[F.col(c) for c in ("id", "uri", "payload", "digest", "bytes", "refers_to")])
    (
        records.select(body.alias("value")).write.option("lineSep", "\n").option("compression", "gzip")
        .option("maxRecordsPerFile", per_file).text(folder)
    )


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


class Inflated:
    """A gzip stream, inflated once in pieces; members may follow each other."""

    def __init__(self, source):
        self.source, self.held, self.over = source, bytearray(), False
        self.engine = zlib.decompressobj(GZIP)

    def more(self) -> bool:
        while not self.over:
            if self.engine.eof:
                rest = self.engine.unused_data.lstrip(b"\0") or self.source.read(PIECE)
                if not rest:
                    self.over = True
                    break
                self.engine = zlib.decompressobj(GZIP)
            else:
                rest = self.engine.unconsumed_tail or self.source.read(PIECE)
                if not rest:
                    raise ValueError("the gzip stream ends early")
            found = self.engine.decompress(rest, PIECE)
            if found:
                self.held += found
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the stream."""
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held.strip(b"\r\n"):
                    raise ValueError("a record's header ends early")
                return None
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise ValueError("a record ends early")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def raw_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of each record of an archive."""
    stream = Inflated(source)
    while (head := stream.until(END)) is not None:
        lead = len(head) - len(head.lstrip(b"\r\n"))
        fields = parse_header(head[lead:])
        body = stream.take(int(fields["content-length"]))
        if stream.take(len(END)) != END:
            raise ValueError("a record does not end with an empty line")
        yield fields, head[lead:] + body + END


def member(record: bytes) -> bytes:
    engine = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return engine.compress(record) + engine.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive under `source` below `target`; returns the index, also written there."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, folder = file_system(target)
        to.create_dir(f"{folder}/archives", recursive=True)
        for batch in rows:
            for uri in batch.column(0).to_pylist():
                at, path = file_system(uri)
                name = path.rsplit("/", 1)[-1].split(".")[0] + ".warc.gz"
                attempt = f"{folder}/archives/.{uuid.uuid4().hex}"
                found, offset = [], 0
                with at.open_input_stream(path, compression=None) as stream, to.open_output_stream(attempt, compression=None) as out:
                    for n, (fields, record) in enumerate(raw_records(stream)):
                        packed = member(record)
                        out.write(packed)
                        found.append((f"{target}/archives/{name}", offset, len(packed), n, fields.get("warc-record-id")))
                        offset += len(packed)
                to.move(attempt, f"{folder}/archives/{name}")
                columns = list(zip(*found, strict=True)) or [()] * 5
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in INDEX.split(", ")]
                )

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "length")
        .where("length > 0").select("path")
    )
    number = max(1, files.count())
    files.repartition(number, "path").mapInArrow(batches, INDEX).write.parquet(f"{target}/index")
    return spark.read.schema(StructType.fromDDL(INDEX)).parquet(f"{target}/index")


def read_records(index: DataFrame) -> DataFrame:
    """Records at the index's offsets, each read with a seek and inflated on its own."""

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        at, path = file_system(rows["file"].iloc[0])
        with at.open_input_file(path) as stream:
            for offset, length in sorted(zip(rows["offset"], rows["length"], strict=True)):
                stream.seek(int(offset))
                record = zlib.decompress(stream.read(int(length)), GZIP)
                head, _, rest = record.partition(END)
                fields = parse_header(head)
                payload = rest[: int(fields["content-length"])]
                digest = (fields.get("warc-payload-digest") or "").removeprefix("sha1:")
                if fields["warc-type"] == "response":
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                found.append(
                    (
                        fields.get("warc-record-id"), fields["warc-type"], fields.get("warc-target-uri"),
                        fields.get("warc-refers-to"), digest,
                        len(payload) if fields["warc-type"] == "response" else int(fields["warc-payload-length"]), payload,
                    )
                )
        return pd.DataFrame(found, columns=[c.split()[0] for c in RECORD.split(", ")])

    part = F.floor(F.col("record") / READ_TOGETHER)
    return index.groupBy("file", part.alias("part")).applyInPandas(read, RECORD)


def archive(
    pages: DataFrame, folder: str | None = None, id_column: str = "page_id", uri_column: str = "url",
    payload_column: str = "html", least_bytes: int = 0,
) -> DataFrame:
    """Write the rows as archives below `folder`, normalise them and return the index."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(uri_column).alias("uri"), F.col(payload_column).alias("payload")
    )
    write_monolithic(with_revisits(rows, least_bytes), f"{folder}/monolithic")
    return normalise(spark, f"{folder}/monolithic", f"{folder}/normal")


def record_number(id_: Column) -> Column:
    """The number in a record id; null where there is none."""
    return F.nullif(F.regexp_extract(id_, "(-?[0-9]+)>$", 1), F.lit("")).cast("long")
