"""Token ids as a canonical, length-limited Huffman file.

Folder layout (Parquet, so any store that Spark reaches will do):

* ``codebook``: id, length. Codes are canonical: by length, then id, counting up.
* ``blocks``: one row per document, an independent block. shard, seq: its place
  (shards ascend by doc_id, seq within a shard); doc_id, n_tokens; bits: the
  codes, high bit first, padded to a byte; marks: the bit offsets of every
  ``MARK``-th token.

Decoding looks up the next ``limit`` bits (25 at most) in one table and starts at
all marks of a batch at once. A block needs nothing but the codebook.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.shared import drop_folder, new_folder
from touchline.llm.textbatch import list_column, text_bytes
from touchline.llm.tokenize_chunks import encoder

MARK, LIMIT = 256, 16


def code_lengths(counts: list[int], limit: int = LIMIT) -> list[int]:
    """Optimal code lengths of at most ``limit`` bits (package-merge)."""
    n = len(counts)
    if n <= 1:
        return [1] * n
    limit = max(limit, (n - 1).bit_length())
    leaves = sorted((c, i) for i, c in enumerate(counts))
    # A package is (weight, parts); its parts are leaf numbers or pairs of packages.
    level: list = [(c, (i,)) for c, i in leaves]
    base = list(level)
    counted = []
    for _ in range(limit - 1):
        counted.append(level)
        packed = [(level[j][0] + level[j + 1][0], None) for j in range(0, len(level) - 1, 2)]
        level = list(merge(base, packed, key=lambda x: x[0]))
    counted.append(level)
    # Walk back: the first m of a level are taken; its packages take twice as many below.
    lengths, m = [0] * n, 2 * n - 2
    for row in reversed(counted):
        packages = 0
        for _, parts in row[:m]:
            if parts is None:
                packages += 1
            else:
                lengths[parts[0]] += 1
        m = 2 * packages
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The code of each id, given the ids ascending."""
    codes, code, last = np.zeros(len(ids), np.int64), 0, 0
    for i in np.lexsort((ids, lengths)).tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def _book(codebook: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, lengths, codes; as many rows as the vocabulary has ids at most."""
    rows = codebook.orderBy("id").toArrow()
    ids, lengths = rows.column("id").to_numpy().astype(np.int64), rows.column("length").to_numpy().astype(np.int64)
    return ids, lengths, canonical_codes(ids, lengths)


def _ids(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    raw, off = text_bytes(column)
    width = np.dtype(dtype).itemsize
    return np.frombuffer(raw.tobytes(), dtype), off // width


def pack(ids: np.ndarray, off: np.ndarray, length_of: np.ndarray, code_of: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of ids (none empty) -> their bytes and offsets, and their marks
    and offsets."""
    n = length_of[ids].astype(np.int64)
    begin = np.cumsum(n) - n
    size, first = np.diff(off), begin[off[:-1]]
    doc_bits = np.append(first[1:], begin[-1] + n[-1]) - first
    byte_off = np.concatenate([np.zeros(1, np.int64), np.cumsum((doc_bits + 7) // 8)])
    pos = begin + np.repeat(byte_off[:-1] * 8 - first, size)
    # Codes go to 64-bit words; one that ends in the next word is cut in two.
    word, room, code = pos >> 6, 64 - (pos & 63) - n, code_of[ids].astype(np.uint64)
    over = np.flatnonzero(room < 0)
    value = code << np.maximum(room, 0).astype(np.uint64)
    value[over] = code[over] >> (-room[over]).astype(np.uint64)
    start = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(int(byte_off[-1] + 15) // 8, np.uint64)
    words[word[start]] = np.bitwise_or.reduceat(value, start)
    words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    out = words.astype(">u8").view(np.uint8)
    marks = (size + MARK - 1) // MARK
    mark_off = np.concatenate([np.zeros(1, np.int64), np.cumsum(marks)])
    nth = np.arange(mark_off[-1]) - np.repeat(mark_off[:-1], marks)
    return out[: byte_off[-1]], byte_off, begin[np.repeat(off[:-1], marks) + nth * MARK] - np.repeat(first, marks), mark_off


def unpack(data: np.ndarray, byte_off: np.ndarray, marks: np.ndarray, mark_off: np.ndarray, size: np.ndarray, symbol: np.ndarray, length: np.ndarray, limit: int) -> np.ndarray:
    """The ids of all documents, decoded from all marks at once."""
    chunks = np.diff(mark_off)
    nth = np.arange(mark_off[-1]) - np.repeat(mark_off[:-1], chunks)
    left = np.minimum(np.repeat(size, chunks) - nth * MARK, MARK)
    pos = marks + np.repeat(byte_off[:-1] * 8, chunks)
    to = np.repeat(np.cumsum(size) - size, chunks) + nth * MARK
    order = np.argsort(-left, kind="stable")
    left, pos, to = left[order], pos[order], to[order]
    # The 32 bits from each byte on hold any code that starts in it.
    data = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    ahead = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    entry = symbol.astype(np.int64) << 6 | length
    out, mask, shift = np.empty(int(size.sum()), np.int64), (1 << limit) - 1, 32 - limit
    for step in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -step, "left"))  # chunks with more than step tokens
        p = pos[:m]
        e = entry[(ahead[p >> 3] >> (shift - (p & 7)).astype(np.uint32)) & mask]
        out[to[:m] + step] = e >> 6
        p += e & 63
    return out


def _by_bytes(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    _, off = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _blocks(dtype: str, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    limit = int(lengths.max(initial=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of, code_of = np.zeros(int(ids.max(initial=0)) + 1, np.int8), np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        length_of[ids], code_of[ids] = lengths, codes
        for batch in batches:
            for part in _by_bytes(batch, "ids"):
                tokens, off = _ids(part.column("ids"), dtype)
                data, byte_off, marks, mark_off = pack(tokens, off, length_of, code_of, limit)
                raw = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(byte_off.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(off)), raw, list_column(marks, mark_off, pa.int64())], ["doc_id", "n_tokens", "bits", "marks"])

    return run


def _decoded(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, digest: bool = False):
    """Batches of blocks -> shard, seq, doc_id and the ids (4 bytes each), or
    with ``digest`` their number and crc32."""
    limit = int(lengths.max(initial=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, length = np.zeros(1 << limit, np.int32), np.zeros(1 << limit, np.int8)
        order = np.argsort(codes << (limit - lengths), kind="stable")
        span = 1 << (limit - lengths[order])
        symbol[: span.sum()], length[: span.sum()] = np.repeat(ids[order], span), np.repeat(lengths[order], span)
        for batch in batches:
            for part in _by_bytes(batch, "bits"):
                data, byte_off = text_bytes(part.column("bits"))
                m = part.column("marks")
                mark_off = m.offsets.to_numpy().astype(np.int64)
                marks = m.values.to_numpy()[mark_off[0] : mark_off[-1]]
                size = part.column("n_tokens").to_numpy()
                raw = unpack(data, byte_off, marks, mark_off - mark_off[0], size, symbol, length, limit).astype("<u4").tobytes()
                off = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]) * 4
                place = [part.column(c) for c in ("shard", "seq", "doc_id")]
                if digest:
                    view = memoryview(raw)
                    crc = [zlib.crc32(view[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*place, pa.array(np.diff(off) // 4), pa.array(crc, pa.int64())], ["shard", "seq", "doc_id", "n_tokens", "ids_crc32"])
                else:
                    column = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([*place, column], ["shard", "seq", "doc_id", "ids"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file and write the
    token file to ``folder``. Null texts count as empty; each document ends
    with ``end_id``. Rows of null doc_id come first, repeated rows stay."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    dtype = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs.mapInArrow(encoder(tokenizer, end_id), "doc_id long, ids binary, seen array<int>, times array<long>").write.option("compression", "zstd").parquet(f"{folder}/ids")
    tokens = spark.read.parquet(f"{folder}/ids")
    counts = tokens.where("seen is not null").select(F.explode(F.arrays_zip("seen", "times")).alias("x")).groupBy(F.col("x.seen").alias("id")).agg(F.sum("x.times").alias("n")).orderBy("id").toArrow()
    # As many rows as the vocabulary has ids at most.
    lengths = code_lengths(counts.column("n").to_pylist())
    spark.createDataFrame(list(zip(counts.column("id").to_pylist(), lengths, strict=True)), "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    book = _book(spark.read.parquet(f"{folder}/codebook"))
    placed = tokens.where("ids is not null").withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    blocks = placed.mapInArrow(_blocks(dtype, *book), "doc_id long, n_tokens long, bits binary, marks array<long>")
    blocks = blocks.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("seq"), "doc_id", "n_tokens", "bits", "marks")
    blocks.write.option("compression", "zstd").parquet(f"{folder}/blocks")
    drop_folder(spark, f"{folder}/ids")  # all in the blocks now


def read_tokens(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """shard, seq, doc_id and the decoded ids (4 bytes each, little-endian); with
    ``digest`` n_tokens and ids_crc32 in their place."""
    book = _book(spark.read.parquet(f"{folder}/codebook"))
    found = "n_tokens long, ids_crc32 long" if digest else "ids binary"
    return spark.read.parquet(f"{folder}/blocks").mapInArrow(_decoded(*book, digest), f"shard int, seq long, doc_id long, {found}")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the token file, read it back: doc_id, start, n_tokens, ids_crc32,
    one row per input row. ``start`` counts the ids of all documents before it
    in the file."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    write_tokens(docs, folder, tokenizer, end_id)
    rows = read_tokens(spark, folder, digest=True)
    shards = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(shards, "shard")
    return rows.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
