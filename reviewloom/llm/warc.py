"""Deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from reviewloom.llm.common import column, running_total, same, text_of
from reviewloom.session import land, shared_dir

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 9562, for URLs
#: Fixed value: profile of revisits with an identical payload (WARC 1.1).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = pa.schema(
    [("shard", pa.int32()), ("seq", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
     ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())]
)
RECORDS = pa.schema(
    [("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
)
READ_ROWS = 2_000


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _one_line(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record(
    page_id: str | None, url: str | None, payload: bytes, first: str | None, date: str
) -> bytes:
    """One record: a response, or a revisit of page ``first``; headers and digests made anew."""
    digest = base32_sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {'urn:none' if url is None else _one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if first is not None:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(first, digest)}",
            f"Refers-To-Page-ID: {first}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """Writes members to files of one shard; a file is closed once it reaches ``roll_bytes``."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, level: int) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.level = shard, roll_bytes, level
        self.seq, self.stream, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.stream is None:
            self.temporary = f"_temporary/{self.shard:06d}-{self.seq:04d}-{uuid.uuid4().hex}"
            self.stream = self.fs.open_output_stream(f"{self.path}/{self.temporary}")
            self.size = self.records = 0
            self.sha = hashlib.sha256()
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # gzip without a time stamp
        member = packer.compress(data) + packer.flush()
        self.stream.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        self.stream = None
        name = f"part-{self.shard:06d}-{self.seq:04d}.warc.gz"
        self.done.append(
            (self.shard, self.seq, self.temporary, name, self.records, self.size, self.sha.hexdigest())
        )
        self.seq += 1


def _writer(folder: str, roll_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, current, roles = None, None, {}
        rows = []
        for batch in batches:
            for shard, kind, page_id, sha, first, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        rows += roller.done
                    roller = _Roller(folder, shard, roll_bytes, level)
                if page_id != current:
                    current, roles = page_id, {}
                if kind == 0:
                    roles[sha] = first
                else:
                    roller.add(record(page_id, url, html.encode(), roles.get(sha), date))
        if roller:
            roller.close()
            rows += roller.done
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), MANIFEST)]
            yield pa.RecordBatch.from_arrays(columns, schema=MANIFEST)

    return run


def _committer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for temporary, name in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                there, final = fs.get_file_info([f"{path}/{temporary}", f"{path}/{name}"])
                if there.type == pafs.FileType.File:
                    fs.move(there.path, final.path)
                elif final.type != pafs.FileType.File:  # else an earlier attempt has moved it
                    raise FileNotFoundError(there.path)
            yield batch

    return run


def _roles(rows: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id``, ``sha``, ``first``: rows that revisit, with the page they revisit. Narrow rows; a
    payload held by many pages is combined in the map tasks, and its join is split by AQE."""
    narrow = rows.select("page_id", "sha", "n_bytes").where(F.col("n_bytes") >= least_bytes)
    shared = narrow.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = shared.where("n > 1 and first is not null").select(F.col("sha").alias("s_sha"), "first")
    held = narrow.join(shared, F.col("sha") == F.col("s_sha"))
    return held.where(~same(F.col("page_id"), F.col("first"))).select("page_id", "sha", "first")


def _shard_bounds(rows: DataFrame, shard_bytes: int) -> list:
    """Least page id of each shard after the first: shards hold about ``shard_bytes`` of payload.

    Found from running totals, so that shards depend on the pages alone, not on sampling. One value
    per ``shard_bytes`` of input reaches the driver (100 TB in shards of 1 GB: 100,000).
    """
    sizes = rows.where("page_id is not null").groupBy("page_id").agg(F.sum("n_bytes").alias("n"))
    placed = running_total(sizes.withColumn("one", F.lit(0)), ["one"], ["page_id"], "n", "before")
    shard = F.floor(F.col("before") / shard_bytes).alias("shard")
    firsts = placed.groupBy(shard).agg(F.min("page_id").alias("page_id"))
    return [r.page_id for r in firsts.where("shard > 0").orderBy("shard").collect()]


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = 1 << 30,
    roll_bytes: int = 1 << 30,
    level: int = 6,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages`` to ``folder`` and return the manifest: a row per file.

    Records are sorted by page id (null first, then by payload digest and url), cut into shards by
    id ranges, one task each, and a shard's files roll at ``roll_bytes`` of compressed records (each
    a gzip member). Of equal payloads (SHA-256) of ``least_bytes`` or more the least page id is a
    response and the others revisit it; rows repeating that id are responses as well. The rows that
    name revisits travel in the same sort as the payloads, just before them.

    Tasks write under temporary names of their own and return manifest rows, which are landed; only
    files named there are renamed, by tasks that may run twice. Then ``_MANIFEST`` is written, and
    what lost attempts left is removed. Readers go by the manifest. Reruns give equal files. Null
    pages count as empty, a null url is written as urn:none; an empty table gives no files.
    """
    spark = pages.sparkSession
    html = text_of(pages, html_col)
    rows = pages.select(
        column(pages, id_col).alias("page_id"),
        F.sha2(html, 256).alias("sha"),
        column(pages, url_col).cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).alias("n_bytes"),
    )
    bounds = _shard_bounds(rows, shard_bytes)
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf(T.IntegerType())
    def shard_of(ids: pd.Series) -> pd.Series:
        found = shared.value
        return pd.Series([0 if pd.isna(i) else bisect.bisect_right(found, i) for i in ids], dtype="int32")

    payloads = rows.select("page_id", "sha", "url", "html").withColumn("kind", F.lit(1))
    roles = _roles(rows, least_bytes).withColumn("kind", F.lit(0))
    both = payloads.unionByName(roles, allowMissingColumns=True)
    placed = both.withColumn("shard", shard_of("page_id") if bounds else F.lit(0))
    order = ["shard", "page_id", "kind", "sha", "url"]
    files = (
        placed.repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions(*order)
        .select(
            "shard", "kind", F.col("page_id").cast("string").alias("page_id"), "sha",
            F.col("first").cast("string").alias("first"), "url", "html",
        )
        .mapInArrow(_writer(folder, roll_bytes, level, date), from_arrow_schema(MANIFEST))
    )
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    written = land(files, "warc")
    written.mapInArrow(_committer(folder), from_arrow_schema(MANIFEST)).drop("temporary").write.parquet(
        f"{folder}/_MANIFEST"
    )
    fs.delete_dir(f"{path}/_temporary")
    return spark.read.parquet(f"{folder}/_MANIFEST")


def _headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:40]!r}")
    headers = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        headers[name] = value
    return headers


def read_record(stream: io.BufferedIOBase) -> tuple | None:
    """The next record as (page id, url, payload bytes, digest, type, refers to), digests checked."""
    headers = _headers(stream)
    if headers is None:
        return None
    block = stream.read(int(headers["Content-Length"]))
    if stream.read(4) != b"\r\n\r\n":
        raise ValueError("a record does not end as it should")
    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']}")
    url = headers["WARC-Target-URI"]
    return (
        headers.get("Page-ID"), None if url == "urn:none" else url, length, digest, kind,
        headers.get("Refers-To-Page-ID"),
    )


def read_warc(spark: SparkSession, folder: str, id_type: T.DataType | str = "long") -> DataFrame:
    """A row per record of the files in the manifest; files are streamed, one record in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    stream, rows = gzip.GzipFile(fileobj=raw, mode="rb"), []
                    while (row := read_record(stream)) is not None:
                        rows.append(row)
                        if len(rows) >= READ_ROWS:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    manifest = spark.read.parquet(f"{folder}/_MANIFEST").select("name")
    spread = manifest.repartition(max(manifest.count(), 1), "name")
    read = spread.mapInArrow(run, from_arrow_schema(RECORDS))
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)]
    return pa.RecordBatch.from_arrays(columns, schema=RECORDS)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder beside the other stages of this application, in the shared folder."""
    folder = shared_dir(spark)
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return f"{folder}/reviewloom/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex[:12]}"
