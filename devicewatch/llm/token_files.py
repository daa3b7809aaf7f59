"""Token ids in files of shuffled planes, and back.

A file holds blocks of a fixed number of ids; only a shard's last block may be shorter. The ids of
a block are transposed into planes, the k-th bytes (or bits) of all ids together, and each plane is
compressed with zstandard by itself: high planes are almost constant, so they nearly vanish. A
block stands in one row of a Parquet table, so files go wherever Spark writes, with the chunk
index beside it: shard, block, first id, number of ids, and the documents that the block touches.

A block's bytes: ``PLN1``, then unsigned 32-bit numbers: ids, planes, crc32 of the ids; the length
of each compressed plane; the planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicewatch.llm.shared import partitions, whole_text
from devicewatch.llm.tokens import MEMO, library_encoder

MAGIC = b"PLN1"
PLANES = {"byte": 4, "bit": 32}
BLOCK = 65_536
_DOCS = "docs array<struct<id:bigint,start:bigint,n_tokens:bigint>>"
_BLOCKS = f"shard int, block int, first long, n_ids long, {_DOCS}, data binary"
_DOC = pa.struct([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_ROWS = "shard int, id long, start long, n_tokens long, at long, ids binary"


def encode_block(ids: np.ndarray, planes: str = "byte", level: int = 3) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    raw = ids.view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        rows = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1,
                           bitorder="little")
    else:
        rows = np.ascontiguousarray(raw.T)
    packer = zstandard.ZstdCompressor(level=level)
    packed = [packer.compress(r.tobytes()) for r in rows]
    return b"".join([
        MAGIC, struct.pack("<III", len(ids), len(packed), zlib.crc32(ids.tobytes())),
        struct.pack(f"<{len(packed)}I", *map(len, packed)), *packed])


def decode_block(data: bytes, ranges: list[tuple[int, int]] | None = None) -> list[np.ndarray]:
    """The ids of some ranges of a block, by default all; a damaged block raises.

    Only a whole block is held against its checksum.
    """
    if data[:4] != MAGIC:
        raise ValueError("not a block of planes")
    count, planes, check = struct.unpack_from("<III", data, 4)
    lengths = struct.unpack_from(f"<{planes}I", data, 16)
    at, rows, unpacker = 16 + 4 * planes, [], zstandard.ZstdDecompressor()
    for n in lengths:
        rows.append(np.frombuffer(unpacker.decompress(data[at:at + n]), dtype=np.uint8))
        at += n
    if planes == 32:
        bits = np.unpackbits(np.stack(rows), axis=1, count=count, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    if any(len(r) != count for r in rows):
        raise ValueError("a block of planes is damaged")
    found = [np.stack([r[a:b] for r in rows], axis=1).reshape(-1).view("<u4")
             for a, b in ranges or [(0, count)]]
    if ranges is None and zlib.crc32(found[0].tobytes()) != check:
        raise ValueError("a block of planes is damaged")
    return found


def _write(encoder: Callable[[], Callable[[str], bytes]], end: int | None, planes: str, block: int):
    names = ["shard", "block", "first", "n_ids", "docs", "data"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(_DOC), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = encoder(), TaskContext.get().partitionId()
        last = b"" if end is None else np.array([end], dtype="<u4").tobytes()
        held, docs, number, first, total = bytearray(), [], 0, 0, 0

        def chunk(size: int) -> pa.RecordBatch:
            nonlocal number, first, docs
            ids = np.frombuffer(bytes(held[:4 * size]), dtype="<u4")
            row = (shard, number, first, size, docs, encode_block(ids, planes))
            del held[:4 * size]
            number, first = number + 1, first + size
            # The document that goes on in the next block is named there too.
            docs = [d for d in docs[-1:] if d["start"] + d["n_tokens"] > first]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py()) + last
                docs.append({"id": id_.as_py(), "start": total, "n_tokens": len(ids) // 4})
                total += len(ids) // 4
                held += ids
                while len(held) >= 4 * block:
                    yield chunk(block)
        if held or docs:
            yield chunk(len(held) // 4)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text", end: int | None = None, planes: str = "byte",
                 block: int = BLOCK, memo: int = MEMO) -> None:
    """Write the ids of all texts in ascending order of document id (nulls first, then by text).

    ``tokenizer`` is a file of the tokenizers library; ``end`` is an id put after every document.
    Null texts count as empty; rows that repeat an id are written each; other columns are ignored.
    ``memo`` is how many pieces of text a worker remembers, twice over.
    ``{path}/blocks`` has the blocks by shard, ``{path}/shards`` where in all ids each shard
    begins: the one number per shard that passes through the driver.
    """
    if planes not in PLANES or block < 1:
        raise ValueError("planes is 'byte' or 'bit', block at least 1")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"),
                       ).withColumn("tie", F.xxhash64("text"))
    ordered = (rows.repartitionByRange(partitions(spark), "id", "tie")
               .sortWithinPartitions("id", "tie", "text").select("id", "text"))
    blocks = ordered.mapInArrow(
        _write(lambda: library_encoder(tokenizer, memo), end, planes, block), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    written = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    totals = written.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    sizes = np.array([r["n"] for r in totals], dtype=np.int64)
    begins = pa.table({"shard": pa.array([r["shard"] for r in totals], type=pa.int32()),
                       "begins": np.cumsum(sizes) - sizes, "n_ids": sizes})
    spark.createDataFrame(begins).coalesce(1).write.parquet(f"{path}/shards")


def _read(whole: bool):
    names = ["shard", "id", "start", "n_tokens", "at", "ids"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                first, size = row.column("first")[0].as_py(), row.column("n_ids")[0].as_py()
                found = []
                for d in row.column("docs")[0].as_py():
                    start, stop = d["start"], d["start"] + d["n_tokens"]
                    if (first <= start and stop <= first + size) == whole:
                        found.append((d, max(start, first), min(stop, first + size)))
                if not found:
                    continue
                data, shard = row.column("data")[0].as_py(), row.column("shard")[0].as_py()
                if whole:
                    ids = decode_block(data)[0]
                    parts = [ids[at - first:to - first] for _, at, to in found]
                else:
                    parts = decode_block(data, [(at - first, to - first) for _, at, to in found])
                rows = [(shard, d["id"], d["start"], d["n_tokens"], at, part.tobytes())
                        for (d, at, _), part in zip(found, parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types,
                                                         strict=True)], names=names)

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``id``, ``start``, ``n_tokens``, ``ids``.

    ``start`` is the number of ids before it in all files. Only documents that reach over the end
    of a block are put together from their parts.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    whole = blocks.mapInArrow(_read(True), _ROWS).drop("at")
    parts = blocks.mapInArrow(_read(False), _ROWS)
    sorted_parts = F.sort_array(F.collect_list(F.struct("at", F.hex("ids").alias("ids"))))
    joined = parts.groupBy("shard", "start", "id", "n_tokens").agg(
        F.unhex(F.array_join(F.transform(sorted_parts, lambda p: p["ids"]), "")).alias("ids"))
    shards = spark.read.schema("shard int, begins long, n_ids long").parquet(f"{path}/shards")
    return whole.unionByName(joined).join(F.broadcast(shards.select("shard", "begins")), "shard") \
        .select("id", (F.col("start") + F.col("begins")).alias("start"), "n_tokens", "ids")
