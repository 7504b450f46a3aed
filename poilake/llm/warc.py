"""WARC archives: a Spark writer with revisit records and a Python data source that reads them."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from poilake.llm.scratch import Scratch

#: Copies of a repeated payload's entry, so that a payload of a third of all rows is spread.
SALTS = 16
#: A record ends with this; Spark's text writer puts it behind each row.
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a string's UTF-8 bytes or a binary."""
    digest = F.upper(F.sha1(payload.cast("binary")))
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _BASE32HEX, _BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line, or null if there is no value; a value cannot end its line."""
    value = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), value)


def plan_records(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int, scratch: Scratch
) -> DataFrame:
    """(id, url, payload, bytes, digest, refers_to): refers_to is null for full responses.

    Of equal payloads of at least ``min_bytes`` bytes the row of the least id is the response.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("").cast(pages.schema[payload_col].dataType))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        payload_digest(payload).alias("digest"),
    )
    copies = (
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    copies = scratch.store(copies.drop("n"), "copies")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    other = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return salted.join(copies, ["digest", "bytes", "salt"], "left").select(
        "id", "url", "payload", "bytes", "digest", other.alias("refers_to")
    )


def records(planned: DataFrame, date: str, uri: str) -> DataFrame:
    """(record): each planned row as the text of one WARC/1.1 record, without ``RECORD_END``."""
    revisit = F.col("refers_to").isNotNull()

    def name(id_: Column) -> Column:
        return F.concat(F.lit(f"<{uri}"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit("\r\n\r\n")
    )
    # A revisit's block holds the response's headers only.
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, name(F.col("refers_to")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length),
    )
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return planned.select(F.concat(head, F.lit("\r\n\r\n"), http, payload).alias("record"))


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    uri: str = "urn:x-page:",
    records_per_file: int = 100_000,
) -> None:
    """Write one record per row below ``path``, by Spark's own commit protocol.

    Equal payloads of at least ``min_bytes`` bytes are stored once: the row of the least id is
    the response and the others are revisits of it. Null payloads are empty; a null url is left
    out, a null id is an empty one; rows that repeat the least id are responses all. No rows
    make an archive without records.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    rows = records(plan_records(pages, id_col, url_col, payload_col, min_bytes, scratch), date, uri)
    (
        rows.write.option("lineSep", RECORD_END)
        .option("compression", "none")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


@dataclass
class _Files(InputPartition):
    """Whole archives that one task reads, one after the other."""

    files: tuple[str, ...]


SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_type string, content_length long, http_length long, "
    "headers map<string,string>, payload binary, file string, offset long"
)
_HEADER = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
_BATCH_BYTES = 8 << 20


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder or file)``: one row per record.

    Options: ``payload`` (default true; false reads headers only), ``partitionBytes`` (size of
    a task's archives, default 128 MiB), ``verify`` (default false; true fails on a response
    whose payload does not have the digest of its header). Archives may be plain or ``.gz``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, [f.name for f in schema.fields])


class WarcReader(DataSourceReader):
    def __init__(self, options, columns: list[str]):
        self.path = options.get("path") or ""
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.size = int(options.get("partitionBytes", 128 << 20))
        self.columns = columns
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes predicates on record type and headers; the others are Spark's to apply."""
        kinds = {EqualTo: "=", EqualNullSafe: "=", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "has"}
        for f in filters:
            inner, negated = (f.child, True) if isinstance(f, Not) else (f, False)
            name = inner.attribute[0] if len(getattr(inner, "attribute", ())) == 1 else None
            if name in _HEADER and isinstance(inner, (IsNull, IsNotNull)):
                self.tests.append((name, "null", isinstance(inner, IsNull) != negated))
            elif name in _HEADER and type(inner) in kinds and not negated:
                self.tests.append((name, kinds[type(inner)], inner.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = pa.fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pa.fs.LocalFileSystem(), self.path)
        info = fs.get_file_info(path)
        if info.type == pa.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else fs.get_file_info(pa.fs.FileSelector(path, recursive=True))
        files = sorted(
            (i for i in found if i.is_file and i.size and not i.base_name.startswith(("_", "."))), key=lambda i: -i.size
        )
        bins: list[list] = []
        total = self.size
        for i in files:
            if total + i.size > self.size:
                bins.append([])
                total = 0
            bins[-1].append(i.path)
            total += i.size
        return [_Files(tuple(b)) for b in bins] or [_Files(())]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            have = headers.get(_HEADER[name])
            if kind == "null":
                ok = (have is None) == value
            elif have is None:
                ok = False
            elif kind == "=":
                ok = have == value
            elif kind == "in":
                ok = have in value
            elif kind == "starts":
                ok = have.startswith(value)
            elif kind == "ends":
                ok = have.endswith(value)
            else:
                ok = value in have
            if not ok:
                return False
        return True

    def _row(self, file: str, at: int, headers: dict[str, str], f: io.BufferedReader, length: int) -> dict:
        row = {name: headers.get(key) for name, key in _HEADER.items()}
        row |= {"content_length": length, "http_length": None, "headers": list(headers.items()), "payload": None}
        row |= {"file": file, "offset": at}
        http = (row["content_type"] or "").startswith("application/http")
        if not (self.payload or http):
            f.seek(length, io.SEEK_CUR)
            return row
        left = length
        if http:
            while left > 0:
                line = f.readline(left)
                left -= len(line)
                if line.lower().startswith(b"content-length:"):
                    row["http_length"] = int(line.split(b":", 1)[1])
                if not line.strip():
                    break
        if not self.payload or row["record_type"] == "revisit":
            f.seek(left, io.SEEK_CUR)
            return row
        body = f.read(left)
        if len(body) < left:
            raise ValueError(f"{file} ends within the record at {at}")
        row["payload"] = body
        if self.verify and (row["payload_digest"] or "").startswith("sha1:"):
            if base64.b32encode(hashlib.sha1(body).digest()).decode() != row["payload_digest"][5:]:
                raise ValueError(f"{file}: the record at {at} does not have its digest")
        return row

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        kinds = {"content_length": pa.int64(), "http_length": pa.int64(), "offset": pa.int64(), "payload": pa.binary(), "headers": pa.map_(pa.string(), pa.string())}
        kind = pa.schema([(c, kinds.get(c, pa.string())) for c in self.columns])
        rows, held = [], 0
        for file in partition.files:
            for row, size in self._records(file):
                rows.append(row)
                held += size
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)

    def _records(self, file: str) -> Iterator[tuple[dict, int]]:
        fs = pa.fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pa.fs.LocalFileSystem()
        with fs.open_input_file(file) as raw:
            f = gzip.GzipFile(fileobj=raw) if file.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
            while True:
                at = f.tell()
                line = f.readline()
                if not line:
                    return
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{file}: no record at {at}")
                headers: dict[str, str] = {}
                while (line := f.readline()).strip():
                    name, _, value = line.decode("utf-8", "replace").partition(":")
                    headers[name.strip().lower()] = value.strip()
                length = int(headers.get("content-length", 0))
                if self._wanted(headers):
                    row = self._row(file, at, headers, f, length)
                    yield row, len(row["payload"] or b"") + 500
                else:
                    f.seek(length, io.SEEK_CUR)


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options: str) -> DataFrame:
    """The records of the archives at ``path``, whose predicates on headers skip payloads."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)
