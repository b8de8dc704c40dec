"""WARC archives of pages, written deterministically and read back.

Writing: cut points over (page_id, tie) come from a sample of rows chosen by
hash, weighted by bytes, so that the same rows give the same ranges whatever
their order and partitions. Rows are sorted by range and each range is written
as gzip members, one a record, rolled to the next file at ``ROLL_BYTES``
compressed. Record headers, HTTP headers and digests are made anew from the
payload; dates are a parameter. Every attempt of a task writes to temporary names of its
own; the files of the attempts that Spark has committed are listed, a second
job gives them their final names (an attempt of it that finds the work done
leaves it), and the ``manifest`` table is written last. Readers open only what
the manifest lists.

Of rows with equal payloads of ``REVISIT_BYTES`` or more, the one with the
largest page_id (ties: the largest tie) is a response, the others revisit it.
These decisions are rows of their own that sort just before the record they
are for, so the payloads are shuffled once and joined with nothing. ``tie`` is a
hash of url and payload.

Files are opened with pyarrow's file systems, by the scheme of the folder.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.shared import drop_folder, materialised, new_folder, small_join

REVISIT_BYTES, ROLL_BYTES, RANGE_BYTES = 1000, 128 << 20, 512 << 20
LEAST_RANGES, SMALL_RANGE, MOST_RANGES, SAMPLED = 256, 256 << 10, 8192, 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
NULL_ID = -(1 << 63)  # null page_ids sort first
CHUNK = 1 << 20
MANIFEST = "file string, records long, bytes long, sha256 string"


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, nth: int) -> str:
    """``nth`` counts the records of one page_id and tie from 0."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{nth}>"


def page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


def record(page_id: int | None, nth: int, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which holds no payload."""
    head = HTTP % len(payload)
    block = head if refers_to else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, nth)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(0x21, 0x7F))))}")
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}", f"WARC-Payload-Length: {len(payload)}"]
    lines += [f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """The same bytes for the same data: no time, no name."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _cut_points(keyed: DataFrame) -> list[tuple[int, int]]:
    """Upper edges of the ranges but the last. At most ``SAMPLED * MOST_RANGES``
    sampled rows, about, reach the driver, and a range for each of the cuts."""
    size = keyed.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    ranges = max(-(-size["b"] // RANGE_BYTES), min(LEAST_RANGES, size["b"] // SMALL_RANGE), 1)
    ranges = min(ranges, MOST_RANGES, max(size["n"], 1))
    share = min(1.0, SAMPLED * ranges / max(size["n"], 1))
    sample = keyed.where(F.pmod(F.xxhash64("id", "tie", F.lit(12)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rows = sorted((r["id"], r["tie"], r["n_bytes"]) for r in sample.groupBy("id", "tie").agg(F.max("n_bytes").alias("n_bytes")).collect())
    run = np.cumsum([200 + r[2] for r in rows])
    at = np.searchsorted(run, run[-1] * np.arange(1, ranges) / ranges) if rows else []
    return sorted({rows[int(i)][:2] for i in at})


def _revisits(keyed: DataFrame) -> DataFrame:
    """id, tie -> winner (whether a row of it is the response), refers_id: for
    the rows whose payload others share."""
    big = keyed.where(F.col("n_bytes") >= REVISIT_BYTES).select("id", "tie", "sha")
    groups = big.groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("id", "tie")).alias("best")).where("n > 1")
    members = small_join(big, groups, "sha", "n")
    rows = members.groupBy("id", "tie").agg(F.first("best").alias("best"))  # one sha each
    return rows.select("id", "tie", ((F.col("id") == F.col("best.id")) & (F.col("tie") == F.col("best.tie"))).alias("winner"), F.col("best.id").alias("refers_id"))


def _writer(folder: str, date: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        attempt, out, shard, part, count, size, digest, name = uuid.uuid4().hex, None, None, 0, 0, 0, None, ""
        done: list[tuple] = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((name, f"range-{shard:05d}-{part:05d}.warc.gz", count, size, digest.hexdigest()))
                out = None

        last, nth, ruling = None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["id"], row["tie"])
                if key != last:
                    last, nth, ruling = key, 0, None
                if row["kind"] == 0:
                    ruling = row
                    continue
                if row["shard"] != shard:
                    close()
                    shard, part = row["shard"], 0
                elif out is not None and size >= roll:
                    close()
                    part += 1
                page_id = None if row["id"] == NULL_ID else row["id"]
                refers = ruling and not (ruling["winner"] and nth == 0)
                refers = record_id(None if ruling["refers_id"] == NULL_ID else ruling["refers_id"], 0) if refers else None
                data = gzip_member(record(page_id, nth, row["url"], row["payload"] or b"", refers, date))
                if out is None:
                    name, count, size, digest = f"{attempt}-{shard:05d}-{part:05d}", 0, 0, hashlib.sha256()
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                digest.update(data)
                count, size, nth = count + 1, size + len(data), nth + 1
        close()
        columns = list(zip(*done, strict=True)) if done else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["temporary", "file", "records", "bytes", "sha256"])

    return run


def _committer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                temporary, final = f"{base}/_temporary/{row['temporary']}", f"{base}/{row['file']}"
                if files.get_file_info(temporary).type != fs.FileType.NotFound:
                    files.move(temporary, final)
                elif files.get_file_info(final).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {temporary} nor {final}")
            yield batch.drop_columns(["temporary"])

    return run


def _prepare(folder: str) -> None:
    files, base = _filesystem(folder)
    files.create_dir(f"{base}/_temporary", recursive=True)


def write_warc(pages: DataFrame, folder: str, date: str = DATE, roll: int = ROLL_BYTES) -> None:
    """``pages`` (page_id, url, html) -> ``folder`` with ``range-*.warc.gz`` and
    the Parquet table ``manifest`` (file, records, bytes, sha256 of the file).

    A record per row, repeated rows too (they count on in their record id); a
    null html is an empty payload, a null url gives no WARC-Target-URI, a null
    page_id an empty one in the record id. Characters that no URI holds are
    percent-encoded. An empty table gives an empty manifest. Other columns are
    not read. The same rows give the same files. A page is one row of a task.
    """
    spark = pages.sparkSession
    sha = F.sha2(F.coalesce(F.col("payload"), F.lit(b"")), 256)
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("payload"))
    rows = rows.withColumn("sha", sha).withColumn("tie", F.xxhash64("url", "sha"))
    keyed = materialised(rows.select("id", "tie", F.unhex("sha").alias("sha"), F.coalesce(F.octet_length("payload"), F.lit(0)).alias("n_bytes")))
    cuts = _cut_points(keyed)

    @F.pandas_udf("int")
    def shard(id: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_left(cuts, k) for k in zip(id.tolist(), tie.tolist(), strict=True)], dtype="int32")

    rulings = _revisits(keyed).select("id", "tie", F.lit(0).alias("kind"), "winner", "refers_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    records = rows.select("id", "tie", F.lit(1).alias("kind"), F.lit(None).cast("boolean").alias("winner"), F.lit(None).cast("long").alias("refers_id"), "url", "payload")
    both = rulings.unionByName(records).withColumn("shard", shard("id", "tie"))
    _prepare(folder)
    placed = both.repartitionByRange("shard").sortWithinPartitions("shard", "id", "tie", "kind")
    placed.mapInArrow(_writer(f"{folder}/_temporary", date, roll), f"temporary string, {MANIFEST}").write.parquet(f"{folder}/_written")
    written = spark.read.parquet(f"{folder}/_written")
    written.repartition("file").mapInArrow(_committer(folder), MANIFEST).write.parquet(f"{folder}/manifest")
    drop_folder(spark, f"{folder}/_temporary")  # what lost or doubled attempts left
    drop_folder(spark, f"{folder}/_written")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a ``.warc.gz`` stream, a member at a
    time; a member that is cut off or holds no whole record is an error."""
    z, data, rest = None, [], b""
    while True:
        chunk = rest or stream.read(CHUNK)
        rest = b""
        if not chunk:
            break
        z = z or zlib.decompressobj(31)
        data.append(z.decompress(chunk))
        if z.eof:
            rest, whole, z, data = z.unused_data, b"".join(data), None, []
            head, _, body = whole.partition(b"\r\n\r\n")
            first, *lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines)
            size = int(headers["Content-Length"])
            if not first.startswith("WARC/1.") or body[size:] != b"\r\n\r\n":
                raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
            yield headers, body[:size]
    if z is not None:
        raise ValueError("the last member is cut off")


def _check(headers: dict[str, str], name: str, data: bytes) -> None:
    if headers[name] != _sha1(data):
        raise ValueError(f"{name} of {headers['WARC-Record-ID']} does not fit")


def _reader(folder: str, payloads: bool):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    for headers, block in records_of(stream):
                        _check(headers, "WARC-Block-Digest", block)
                        revisit = headers["WARC-Type"] == "revisit"
                        payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                        if not revisit:
                            _check(headers, "WARC-Payload-Digest", payload)
                        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        size = int(headers["WARC-Payload-Length"]) if revisit else len(payload)
                        rows.append((page_of(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], page_of(headers["WARC-Refers-To"]) if revisit else None, headers.get("WARC-Target-URI"), file, payload)[: len(names)])
                        held += len(block) if payloads else 256
                        if held > CHUNK:
                            yield out()
                            rows, held = [], 0
                if rows:
                    yield out()

    return run


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records that the manifest of ``folder`` lists: page_id, payload_bytes,
    payload_digest (both of the full payload, also for revisits), record_type,
    refers_to, url, file, and with ``payloads`` the payload (null for revisits).
    Digests are checked; a file is one task's work, read a record at a time."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string" + ", payload binary" * payloads
    listed = spark.read.parquet(f"{folder}/manifest")
    return listed.select("file").repartitionByRange("file").mapInArrow(_reader(folder, payloads), schema)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives of ``pages`` to ``folder`` (default: a new one under the
    shared folder) and read them back: ``read_warc``'s rows."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_warc(pages, folder)
    return read_warc(spark, folder)
