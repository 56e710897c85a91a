"""Token ids as fixed-width bits: a block format, its writer and its readers."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep
from hillwarden.llm.tokens import encoder
from hillwarden.llm.words import groups_of

MAGIC = b"HWB1"
HEAD = struct.Struct("<4sBxxxQQ")  # magic, bits per id, number of texts, number of ids

WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}

STORED = "shard int, block int, n_docs long, n_tokens long, doc_ids array<bigint>, payload binary"
BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])


def width_of(vocab: int) -> int:
    """Least number of bits that holds every id."""
    return max(1, (max(1, vocab) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids one after the other, `bits` each, least bit first."""
    if not len(ids):
        return b""
    if bits in WHOLE:  # the same bytes, without spreading the bits
        return ids.astype(WHOLE[bits]).tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, first: int, count: int) -> np.ndarray:
    """`count` ids from number `first` on, without reading those before."""
    if bits in WHOLE:
        return np.frombuffer(data, WHOLE[bits], count, first * bits // 8).astype(np.uint32)
    lo, hi = first * bits, (first + count) * bits
    part = np.frombuffer(data, np.uint8)[lo // 8 : -(-hi // 8)]
    flat = np.unpackbits(part, bitorder="little")[lo % 8 : lo % 8 + count * bits]
    return flat.reshape(count, bits) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32)) if count else np.zeros(0, np.uint32)


def write_block(ids: np.ndarray, begin: np.ndarray, bits: int) -> bytes:
    """Header, offset of each text's first id (and the end), packed ids."""
    return HEAD.pack(MAGIC, bits, len(begin) - 1, len(ids)) + begin.astype("<u8").tobytes() + pack(ids, bits)


def read_block(block: bytes) -> tuple[int, np.ndarray, memoryview]:
    """Bits per id, text offsets and packed ids of a block."""
    magic, bits, texts, count = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    begin = np.frombuffer(block, "<u8", texts + 1, HEAD.size).astype(np.int64)
    return bits, begin, memoryview(block)[HEAD.size + 8 * (texts + 1) :]


def text_ids(block: bytes, number: int) -> np.ndarray:
    """Ids of one text of a block, by random access."""
    bits, begin, data = read_block(block)
    return unpack(data, bits, int(begin[number]), int(begin[number + 1] - begin[number])).astype(np.uint32)


def text_groups(batch: pa.RecordBatch, limit: int = 1 << 21) -> Iterator[tuple[list[int | None], list[str]]]:
    """doc_ids and texts of stretches of a batch, of up to `limit` characters or one longer text each; only one stretch's strings are made at a time."""
    chars = pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)
    for i, j in groups_of(np.concatenate([[0], np.cumsum(chars, dtype=np.int64)]), limit):
        part = batch.slice(i, j - i)
        yield part.column("doc_id").to_pylist(), part.column("text").to_pylist()


def write_tokens(docs: DataFrame, path: str, *, end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Stores every text's ids (with end_id after each) in ascending doc_id order; returns the stored blocks.

    The rows are dealt by ranges of doc_id, sorted in each, encoded, and cut
    into blocks of about two million characters; a text is never cut. Blocks
    are rows of a table in the shared folder, written by Spark's committer,
    so a lost executor leaves no half file and any file system will do.

    Null text counts as empty and has the end id alone. Null doc_ids come
    first; repeated doc_ids are ordered by text. An empty table has no blocks.
    Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, tool = TaskContext.get().partitionId(), 0, encoder(path)
        bits = width_of(max(tool.vocab, end_id + 1))
        for batch in batches:
            for own, texts in text_groups(batch):
                ids, begin = tool.batch(texts)
                ids, begin = np.insert(ids, begin[1:], end_id), begin + np.arange(len(texts) + 1)
                row = [shard, number, len(texts), len(ids), own, write_block(ids, begin, bits)]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, BLOCK.types, strict=True)], schema=BLOCK)
                number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    return keep(dealt.sortWithinPartitions("doc_id", "text").mapInArrow(encode, STORED))


def read_tokens(blocks: DataFrame) -> DataFrame:
    """One row per text of stored blocks: doc_id, start, n_tokens, ids_crc32, in the order they were written.

    Each block's first place follows from the block totals alone: one row per
    shard is summed in order, then the blocks of each shard.
    """
    from pyspark.sql import Window

    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("shard_start"))
    inside = blocks.select("shard", "block", "n_tokens").withColumn(
        "block_start", F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    )
    place = inside.join(before, "shard").select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("first"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, block, doc_ids, payload in zip(batch["shard"], batch["block"], batch["doc_ids"], batch["payload"], strict=True):
                bits, begin, data = read_block(payload)
                ids = unpack(data, bits, 0, int(begin[-1])).astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pd.DataFrame({
                    "shard": shard, "block": block, "doc_id": pd.array([None if pd.isna(d) else int(d) for d in doc_ids], "Int64"),
                    "inner": begin[:-1], "n_tokens": np.diff(begin), "ids_crc32": np.array(crc, np.int64),
                })

    read = blocks.select("shard", "block", "doc_ids", "payload").mapInPandas(
        decode, "shard int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return read.join(place, ["shard", "block"]).select("doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
