"""Best-fit packing by the configuration linear program over the length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep
from hillwarden.llm.token_files import text_groups
from hillwarden.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, path: str, *, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Every text's ids with end_id after them, cut into pieces of `size`; a first piece holds what is left over.

    A worker holds the strings and ids of one stretch of half a million characters (or one longer text), not of a batch.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for doc_ids, texts in text_groups(batch, 1 << 19):
                ids, begin = tool.batch(texts)
                ids, begin = np.insert(ids, begin[1:], end_id).astype("<u4"), (begin + np.arange(len(texts) + 1)).tolist()
                out = []
                for d, a, b in zip(doc_ids, begin[:-1], begin[1:], strict=True):
                    marks = [a, *range(a + ((b - a) % size or size), b + 1, size)]
                    for n, (x, y) in enumerate(zip(marks, marks[1:], strict=False)):
                        out.append((d, n, x - a, y - x, zlib.crc32(ids[x:y].tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), PIECE.types, strict=True)], schema=PIECE)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def knapsack(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to the size, the most valuable unbounded filling: its value and the length to take first (0: leave one place)."""
    size = len(value) - 1
    best, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    back = np.zeros(size + 1)  # best, backwards, so that a slice lines up with the lengths
    for c in range(1, size + 1):
        reach = value[1 : c + 1] + back[size - c + 1 : size + 1]
        s = int(reach.argmax())
        if reach[s] > best[c - 1]:
            best[c], last[c] = reach[s], s + 1
        else:
            best[c] = best[c - 1]
        back[size - c] = best[c]
    return best, last


def fractional(demand: np.ndarray, rounds: int, slack: float, rate: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Configurations (lengths, counts) and how often each is used, from multiplicative weights on the covering program.

    Every length has a price, at first its share of a sequence. Each round one
    knapsack prices all fillings; each length's own best configuration, if its
    value is within `slack` of the highest, is used for 1/rounds of that
    length's demand, and prices fall exponentially with what has been covered.
    """
    size = len(demand) - 1
    lengths = np.flatnonzero(demand)
    if not len(lengths):
        return []
    need = np.maximum(demand, 1).astype(float)
    covered = np.zeros(size + 1)
    noise = np.random.default_rng(7)
    share = lengths / size
    out = []
    for r in range(rounds):
        value = np.zeros(size + 1)
        left = np.clip(covered[lengths] - (r / rounds), -1, 3)
        value[lengths] = share * np.exp(-rate * left) * (1 + 0.02 * noise.random(len(lengths)))
        best, last = knapsack(value)
        worth = value[lengths] + best[size - lengths]
        now = np.zeros(size + 1)
        for s in lengths[worth >= (1 - slack) * worth.max()].tolist():
            count: dict[int, int] = {s: 1}
            c = size - s
            while c > 0:
                if last[c]:
                    count[int(last[c])] = count.get(int(last[c]), 0) + 1
                    c -= last[c]
                else:
                    c -= 1
            ls, ks = np.array(list(count), np.int64), np.array(list(count.values()), np.int64)
            times = min(float(demand[s]) / rounds / count[s], float((need[ls] * max(1.0, rounds / 8) / rounds / ks).min()))
            now[ls] += ks * times
            out.append((ls, ks, times))
        covered += now / need
    return out


def best_fill(left: np.ndarray, room: int) -> np.ndarray:
    """Counts that fill `room` best from what is left: the largest that fits, then the next, with a look for an exact end."""
    count = np.zeros_like(left)
    while room > 0:
        fits = np.flatnonzero(left[: room + 1] - count[: room + 1] > 0)
        if not len(fits):
            break
        s = int(fits[-1])
        if room != s and len(fits) > 1:
            rest = room - fits  # an exact pair beats the largest
            pair = fits[(rest > 0) & (left[rest] - count[rest] - (rest == fits) > 0)]
            if len(pair):
                s = int(pair[-1])
        count[s] += 1
        room -= s
    return count


Use = tuple[np.ndarray, np.ndarray, int]  # lengths, how many of each in a sequence, number of sequences


def greedy(demand: np.ndarray) -> list[Use]:
    """Best-fit decreasing, run by run: a filling is repeated while its lengths last."""
    left, size, out = demand.copy(), len(demand) - 1, []
    while True:
        rest = np.flatnonzero(left)
        if not len(rest):
            return out
        s = int(rest[-1])
        count = np.zeros_like(left)
        count[s] = 1
        count += best_fill(left - count, size - s)
        ls = np.flatnonzero(count)
        ks = count[ls]
        times = int((left[ls] // ks).min())
        left[ls] -= ks * times
        out.append((ls, ks, times))


def plan(demand: np.ndarray, *, rounds: int = 48, slack: float = 0.25, rate: float = 6.0) -> list[Use]:
    """Configurations and whole numbers of sequences that hold exactly the demand (items per length, index 0 unused).

    Uses are rounded along their running sum, the latest rounds first, and cut
    to what is left to cover; what then remains is filled best-fit decreasing.
    """
    left, out, carry = demand.copy(), [], 0.0
    for ls, ks, x in reversed(fractional(demand, rounds, slack, rate)):
        carry += x
        times = min(int(carry), int((left[ls] // ks).min()))
        carry -= int(carry)
        if times > 0:
            left[ls] -= ks * times
            out.append((ls, ks, times))
    return out + greedy(left)


def slots(chosen: list[Use]) -> pd.DataFrame:
    """For each length, ranges of its items' ranks: first rank, items per sequence, first sequence, first offset."""
    rows, ranks, sequence = [], {}, 0
    for ls, ks, times in chosen:
        at = 0
        for s, k in zip(ls.tolist(), ks.tolist(), strict=True):
            rows.append((s, ranks.get(s, 0), k, sequence, at))
            ranks[s] = ranks.get(s, 0) + k * times
            at += s * k
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank0", "per", "sequence0", "offset0"])


def pack_documents(docs: DataFrame, path: str, *, size: int = 2048, end_id: int = 0, buckets: int = 64, rounds: int = 48) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only the histogram (at most `size` rows) and the plan, a bounded number of
    configurations, are held by the driver. Pieces of a length are numbered
    over `buckets` shares, so a length that a third of all pieces have is
    spread; their place follows from their number.

    Null text counts as empty and is one piece of the end id. Repeated rows
    are packed each. An empty table gives no rows. Other columns are not read.
    """
    cut = keep(pieces(docs, path, size=size, end_id=end_id))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    demand = np.zeros(size + 1, np.int64)
    for s, n in histogram.items():
        demand[s] = n
    full = int(demand[size])
    demand[size] = 0
    table = slots([(np.array([size]), np.array([1]), full), *plan(demand, rounds=rounds)])
    by_length = {s: g[["rank0", "per", "sequence0", "offset0"]].to_numpy(np.int64) for s, g in table.groupby("length")}
    shared = docs.sparkSession.sparkContext.broadcast(by_length)

    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    mine = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("number", mine - 1).join(before.drop("n"), ["length", "bucket"])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plans = shared.value
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for s, rows in batch.groupby("length").indices.items():
                p = plans[s]
                rank = batch["rank"].to_numpy()[rows]
                r = np.searchsorted(p[:, 0], rank, "right") - 1
                inner = rank - p[r, 0]
                sequence[rows] = p[r, 2] + inner // p[r, 1]
                offset[rows] = p[r, 3] + inner % p[r, 1] * s
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset, doc_id=batch["doc_id"].astype("Int64"))

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("rank")).mapInPandas(
        place, PIECES + ", sequence_id long, offset long"
    )

