"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hillwarden.llm.words import text_bytes

ORDER = 4
LEAD = np.full(ORDER, 10, np.uint8)  # what a text follows: line feeds
CHUNK = 1 << 20
SLOTS = 1 << 22  # numbers a worker's table of code lengths holds


def windows(data: np.ndarray, at: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of texts i..j the byte and the ORDER before it as one number, and where each text begins."""
    parts, begin = [], [0]
    for t in range(i, j):
        own = data[at[t] : at[t + 1]]
        if len(own):
            whole = np.concatenate([LEAD, own]).astype(np.uint64)
            code = whole[: len(own)].copy()
            for k in range(1, ORDER + 1):
                code = (code << np.uint64(8)) | whole[k : k + len(own)]
            parts.append(code)
        begin.append(begin[-1] + len(own))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(begin)


def _groups(at: np.ndarray) -> Iterator[tuple[int, int]]:
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        yield i, j
        i = j


class Trees:
    """Frozen byte context trees of several languages.

    A byte's code length is that of its count in the longest known context;
    each longer known context that lacks it costs that context's escape
    (escape share: distinct followers over followers plus distinct ones).
    A byte no context knows costs one of 256.
    """

    def __init__(self, languages: list[str], nodes: list[list[tuple[np.ndarray, np.ndarray]]]):
        """nodes[l][d]: sorted numbers of context and byte of order d, and their counts."""
        self.languages = languages
        self.levels = []
        for orders in nodes:
            levels = []
            for key, n in orders:
                context, first = np.unique(key >> np.uint64(8), return_index=True)
                total = np.add.reduceat(n, first).astype(float) if len(first) else np.zeros(0)
                kinds = np.diff(np.append(first, len(key))).astype(float)
                of = np.repeat(np.arange(len(first)), kinds.astype(np.int64))
                levels.append((key, -np.log2(n / (total + kinds)[of]) if len(key) else np.zeros(0), context, -np.log2(kinds / (total + kinds))))
            self.levels.append(levels)
        slots = 1 << max(10, (SLOTS // max(1, len(languages))).bit_length() - 1)
        self.shift = np.uint64(64 - slots.bit_length() + 1)
        self.known = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
        self.cost = np.zeros((slots, len(languages)), np.float32)

    def exact(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each window's last byte in each language."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        for l, levels in enumerate(self.levels):
            bits, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
            for d in range(ORDER, -1, -1):
                key, cost, context, escape = levels[d]
                if not len(key):
                    continue
                want = codes & np.uint64((1 << (8 * (d + 1))) - 1)
                i = np.minimum(np.searchsorted(key, want), len(key) - 1)
                hit = open_ & (key[i] == want)
                bits[hit] += cost[i[hit]]
                open_ &= ~hit
                c = np.minimum(np.searchsorted(context, want >> np.uint64(8)), len(context) - 1)
                fall = open_ & (context[c] == want >> np.uint64(8))
                bits[fall] += escape[c[fall]]
            bits[open_] += 8.0
            out[:, l] = bits
        return out

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """As exact(), with a table of windows met before."""
        slot = ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = self.cost[slot]
        miss = np.flatnonzero(self.known[slot] != codes)
        if len(miss):
            fresh, back = np.unique(codes[miss], return_inverse=True)
            cost = self.exact(fresh)
            out[miss] = cost[back]
            place = ((fresh * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
            self.known[place] = fresh
            # of windows that share a place the last stays, in both tables
            self.cost[place] = cost
        return out

    def lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code length of each whole text in each language, in bits."""
        total = np.zeros((len(at) - 1, len(self.languages)))
        for i, j in _groups(at):
            codes, begin = windows(data, at, i, j)
            full = np.flatnonzero(np.diff(begin)) + i
            for a in range(0, len(codes), CHUNK):
                part = self.bits(codes[a : a + CHUNK])
                marks = begin[full - i]
                lo = max(0, int(np.searchsorted(marks, a, "right")) - 1)
                hi = int(np.searchsorted(marks, a + len(part)))
                total[full[lo:hi]] += np.add.reduceat(part, np.maximum(marks[lo:hi] - a, 0), axis=0, dtype=np.float64)
        return total


def learn(labelled: DataFrame, *, rows_per_language: int = 2000, max_nodes: int = 400_000) -> Trees:
    """Trees from a bounded sample of labelled texts (columns lang, text; by hash of the text).

    `rows_per_language` bounds the sample in expectation, `max_nodes` the nodes
    of one order over all languages; those of the highest counts stay. Rows
    without a language are not used; with no labelled row there is no tree.
    """
    labelled = labelled.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Trees([], [])
    number = {x: k for k, x in enumerate(languages)}
    share = F.create_map(*[F.lit(v) for x in languages for v in (x, min(1.0, rows_per_language / sizes[x]))])
    code = F.create_map(*[F.lit(v) for x in languages for v in (x, number[x])])
    chance = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(chance < share[F.col("lang")]).select(code[F.col("lang")].alias("l"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            own = batch.column("l").to_numpy(zero_copy_only=False)
            for i, j in _groups(at):
                codes, begin = windows(data, at, i, j)
                language = np.repeat(own[i:j], np.diff(begin))
                for l in np.unique(language):
                    key, n = np.unique(codes[language == l], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), l, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["l", "key", "n"]
                    )

    deep = sample.mapInArrow(count, "l int, key long, n long")
    # a node of a lower order counts what its longer contexts do
    orders = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col("key").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("key")) for d in range(ORDER + 1)]))
    full = deep.groupBy("l", "key").agg(F.sum("n").alias("n"))
    nodes = full.select("l", "n", orders.alias("x")).groupBy("l", "x.d", "x.key").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("l", "d").orderBy(F.desc("n"), "key"))
    kept = nodes.withColumn("rank", rank).where(F.col("rank") <= max(256, max_nodes // len(languages))).select("l", "d", "key", "n").toPandas()
    out = []
    for l in range(len(languages)):
        levels = []
        for d in range(ORDER + 1):
            x = kept[(kept.l == l) & (kept.d == d)].sort_values("key")
            levels.append((x.key.to_numpy(np.int64).astype(np.uint64), x.n.to_numpy(np.int64)))
        out.append(levels)
    return Trees(languages, out)


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred and score of every row of docs, from its whole text alone.

    The language of the least code length is predicted (of equals the first by
    name); score is its share of the likelihoods. Texts that are null or hold
    no letter, and any text if no language was learned, give `und` and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.languages, "und"], dtype=object)
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            if own.languages:
                bits = own.lengths(data, at)
                best = bits.argmin(axis=1)
                rest = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                best[~letter] = len(own.languages)
                score = np.where(letter, 1 / rest, 0.0)
            else:
                best, score = np.zeros(len(letter), np.int64), np.zeros(len(letter))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    letter = F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text", letter.alias("letter")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame, *, rows_per_language: int = 2000) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 4 is not 2 and predicts every row.

    doc_id, held_out, lang_pred, score. A null doc_id has no remainder: such
    rows are predicted, not learned from, and held_out is null. Repeated rows
    are predicted each. Other columns are not read.
    """
    held = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    return predict(held, learn(held.where("not held_out").select("lang", "text"), rows_per_language=rows_per_language))
