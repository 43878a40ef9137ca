"""Deterministic sharded WARC writer and reader.

Writer: shard bounds come from an exact histogram of payload bytes over the
ids, so the same rows always give the same shards, whatever the cluster. One
shuffle range-sorts the records; each task sorts its shard by (id, digest),
regenerates headers and digests from the payload, and rolls files by
compressed size. Files get temporary names per task attempt; the manifest,
which lists the files of the attempts that counted, is written first, then
files are renamed to their final names, and the completion mark is last. A
lost executor only leaves temporary files that no manifest names.

Payloads that equal an earlier one (smallest id first) become revisit records
without a body. The small side (repeated digests) is aggregated before its
shuffle, and reaches the page as an extra row of the same sort, so payloads
are shuffled once and a digest shared by many pages meets no join of payloads.

Defined results: null html is an empty payload; payloads under
``min_revisit_bytes`` are always responses; rows with the same id and payload
are all of the same type; a null id sorts first and is never referred to; an
empty table gives an archive without files; extra columns are ignored.
Files are written through ``pyarrow.fs``, so the folder may be on any file
system that it knows (local or shared mounts, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.llm.common import new_folder

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 64 << 20
SHARD_BYTES = 256 << 20
WARC_DATE = "2024-01-01T00:00:00Z"

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_MANIFEST = "shard long, seq long, temp string, name string, bytes long, records long, sha256 string"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path inside it, for a URI or a plain path."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}')}>"


def _digest_field(payload: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(payload).digest()).decode().rstrip("=")


def _clean(value: str) -> str:
    return "".join(" " if c in "\r\n" else c for c in value)


def make_record(page_id, url, payload: bytes, refers_to, date: str = WARC_DATE) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to`` given) has no body."""
    digest = hashlib.sha256(payload).hexdigest()
    body = b"" if refers_to is not None else payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", _digest_field(payload)),
        ("WARC-Block-Digest", _digest_field(body)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """A gzip member without time or name, so equal records give equal bytes."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


# ---------------------------------------------------------------- writer

def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(page_id, digest, refers_to)`` of every page that repeats an earlier payload."""
    light = pages.select(
        "page_id", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest"), F.octet_length("html").alias("n")
    ).where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull())
    first = (
        light.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("last > refers_to")
        .drop("last")
    )
    return light.join(first, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def shard_bounds(pages: DataFrame, shard_bytes: int, bins_per_shard: int = 64) -> list[int]:
    """Upper id bounds (exclusive) that cut the bytes into shards of about
    ``shard_bytes``, from a histogram of exact sums; the driver gets
    at most ``bins_per_shard`` rows per shard."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.lit(500)
    total, low, high = pages.agg(F.sum(size.cast("long")), F.min("page_id"), F.max("page_id")).first()
    if total is None or low is None or total <= shard_bytes:
        return []
    bins = -(-total // shard_bytes) * bins_per_shard
    width = max(1, -(-(high - low + 1) // bins))
    rows = (
        pages.where(F.col("page_id").isNotNull())
        .groupBy(F.expr(f"(page_id - {low}L) div {width}L").alias("bin"))
        .agg(F.sum(size.cast("long")).alias("bytes"))
        .orderBy("bin")
    )
    bounds, filled = [], 0
    for row in rows.toLocalIterator():
        if filled and filled + row["bytes"] > shard_bytes:
            bounds.append(low + row["bin"] * width)
            filled = 0
        filled += row["bytes"]
    return bounds


def write_archive(
    pages: DataFrame,
    folder: str,
    roll_bytes: int = ROLL_BYTES,
    shard_bytes: int = SHARD_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    date: str = WARC_DATE,
) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) as rolled
    ``.warc.gz`` files under ``folder``; returns the committed manifest."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    bounds = shard_bounds(pages, shard_bytes)
    shard = _shard_of(bounds)("page_id") if bounds else F.lit(0)
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    body = pages.select("page_id", digest.alias("digest"), F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("refers_to"))
    refs = mark_revisits(pages, min_revisit_bytes).select(
        "page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to"
    )
    rows = body.unionByName(refs).withColumn("shard", shard)
    sorted_rows = rows.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    written = sorted_rows.mapInArrow(_shard_writer(folder, roll_bytes, date), _MANIFEST)
    path = f"{folder}/manifest"
    written.write.parquet(path)
    manifest = spark.read.schema(written.schema).parquet(path)
    # idempotent renames, so a retried task does no harm
    manifest.repartition(max(1, len(bounds) + 1)).mapInArrow(_committer(folder), "done long").agg(F.sum("done")).first()
    spark.createDataFrame([(json.dumps({"complete": True}),)], "value string").coalesce(1).write.text(f"{folder}/complete")
    return manifest


def _shard_of(bounds: list[int]):
    """Number of bounds at or below the id (8 bytes a shard travel to the tasks)."""
    cuts = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0).astype("int64"), "right")).astype("int32"))

    return shard


def _shard_writer(folder: str, roll_bytes: int, date: str):
    def write(batches):
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        system, root = open_folder(folder)
        system.create_dir(f"{root}/_temporary", recursive=True)
        rows, out, ref = [], None, None

        def close():
            nonlocal out
            if out is not None:
                out["stream"].close()
                rows.append((out["shard"], out["seq"], out["temp"], out["name"], out["bytes"], out["records"], out["sha"].hexdigest()))
                out = None

        seq = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                if row["kind"] == 0:
                    ref = (key, row["refers_to"])
                    continue
                refers_to = ref[1] if ref and ref[0] == key else None
                member = gzip_member(make_record(row["page_id"], row["url"], (row["html"] or "").encode(), refers_to, date))
                number = row["shard"]
                if out is not None and (out["shard"] != number or out["bytes"] + len(member) > roll_bytes):
                    close()
                if out is None:
                    at = seq[number] = seq.get(number, -1) + 1
                    temp = f"_temporary/{attempt}-{number:06d}-{at:05d}.warc.gz"
                    out = {"shard": number, "seq": at, "temp": temp, "name": f"part-{number:06d}-{at:05d}.warc.gz", "bytes": 0, "records": 0, "sha": hashlib.sha256()}
                    out["stream"] = system.open_output_stream(f"{root}/{temp}", compression=None)
                out["stream"].write(member)
                out["sha"].update(member)
                out["bytes"] += len(member)
                out["records"] += 1
        close()
        names = ["shard", "seq", "temp", "name", "bytes", "records", "sha256"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=_manifest_schema())

    return write


def _manifest_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in _MANIFEST.split(", "))])


def _committer(folder: str):
    def commit(batches):
        system, root = open_folder(folder)
        for batch in batches:
            done = 0
            for row in batch.to_pylist():
                final = f"{root}/{row['name']}"
                if system.get_file_info(final).type == fs.FileType.NotFound:
                    system.move(f"{root}/{row['temp']}", final)
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["done"])

    return commit


# ---------------------------------------------------------------- reader

def iter_records(stream, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a file of gzip members, one member in memory at a time."""
    z, parts = zlib.decompressobj(31), []
    data = stream.read(chunk)
    while data:
        parts.append(z.decompress(data))
        if z.eof:
            data = z.unused_data or stream.read(chunk)
            yield parse_record(b"".join(parts))
            z, parts = zlib.decompressobj(31), []
        else:
            data = stream.read(chunk)
    if any(parts):
        raise ValueError("the file ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    body = rest[:size]
    if len(body) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has a wrong length")
    if fields["WARC-Block-Digest"] != _digest_field(body):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has a wrong digest")
    return fields, body


_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archive(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of a committed archive: one task per file, digests checked."""
    files = max(1, manifest.count())

    def read(batches):
        system, root = open_folder(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for fields, body in iter_records(stream):
                        rows.append(_record_row(fields, body if payloads else None))
                        size += len(body) if payloads else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_record_schema())
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_record_schema())

    return manifest.select("name").repartition(files).mapInArrow(read, _RECORDS)


def _record_row(fields: dict[str, str], body: bytes | None) -> dict:
    number = lambda k: int(fields[k]) if k in fields else None
    encoded = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    digest = base64.b32decode(encoded + "=" * (-len(encoded) % 8)).hex()
    return {
        "page_id": number("X-Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": number("X-Payload-Length"),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload": body if fields["WARC-Type"] == "response" else None,
    }


def _record_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in _RECORDS.split(", "))])


def archive_report(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and report the records read back."""
    folder = new_folder(spark, "warc")
    manifest = write_archive(pages, folder, **options)
    return read_archive(manifest, folder, payloads=False).drop("payload", "url")
