"""Text quality by compression: zstandard dictionaries of good and bad labelled text, and a calibrated size difference."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep

BLOCK = 2048  # bytes that are compressed at once, so that the dictionary and not the text's own past counts
DICT_BYTES = 112_640
LEVEL = 3


def blocks(raw: bytes) -> list[bytes]:
    """The whole text in consecutive pieces."""
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def dictionary(pieces: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; where there is too little text to train one, the pieces themselves are its content."""
    total = sum(map(len, pieces))
    if len(pieces) >= 20 and total >= 20 * 1024:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 4)), pieces).as_bytes()
        except zstandard.ZstdError:  # all pieces alike
            pass
    return b"".join(pieces)[-size:]


@dataclass
class Model:
    """Dictionaries of both classes and the calibration: weights of the two size measures, and the bias."""

    good: bytes = b""
    bad: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = 0.0
    prior: float = 0.5

    def __post_init__(self) -> None:
        self._pair = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def _compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        if self._pair is None:
            made = []
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
            self._pair = tuple(made)
        return self._pair

    def measures(self, raw: bytes) -> tuple[float, float]:
        """(bad - good) / (bad + good) of the compressed sizes, and the log of the good size over the plain size."""
        with_good, with_bad = self._compressors()
        good = bad = 0
        for piece in blocks(raw):
            good += len(with_good.compress(piece))
            bad += len(with_bad.compress(piece))
        return (bad - good) / max(1, bad + good), float(np.log((good + 1) / (len(raw) + 1)))

    def score(self, raw: bytes) -> float:
        """Chance of label 1; the share of label 1 for an empty text, or where only one label was seen."""
        if not raw or not self.good:
            return self.prior
        z = float(np.dot(self.weights, self.measures(raw))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def calibrated(x: np.ndarray, y: np.ndarray, *, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights and bias of a logistic regression of y on the columns of x, by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        size = np.abs(step).max()
        w += step * min(1.0, 8.0 / max(size, 1e-12))
        if size < 1e-7:
            break
    return w


def _pieces(rows: DataFrame, most: int) -> dict[tuple[int, int], list[bytes]]:
    """Pieces of the texts by fold and label, about `most` bytes of each label in each fold, chosen by hash.

    `most` bounds what is collected; its expectation is exact as pieces are kept independently.
    """
    size = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    share = {k: min(1.0, most / max(1, n)) for k, n in size.items()}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, fold, label, text in batch[["key", "fold", "label", "text"]].itertuples(index=False):
                own = blocks(text.encode())
                draw = np.random.default_rng(int(key) & ((1 << 63) - 1)).random(len(own))
                out += [(key, i, fold, label, own[i]) for i in np.flatnonzero(draw < share[(fold, label)])]
            yield pd.DataFrame(out, columns=["key", "place", "fold", "label", "piece"])

    got = rows.mapInPandas(cut, "key long, place int, fold int, label int, piece binary").toPandas().sort_values(["key", "place"])
    return {k: [bytes(p) for p in g["piece"]] for k, g in got.groupby(["fold", "label"])}


def learn(labelled: DataFrame, *, fit_rows: int = 20_000, dict_input: int = 4_000_000) -> Model:
    """Model from a bounded sample of rows with `text` and `label` 0 or 1: `fit_rows` texts in expectation, chosen by
    hash, and of these `dict_input` bytes a label and fold for the dictionaries. Equal texts count once, with the
    majority label (1 at a tie). Sizes are calibrated across two folds: no text is measured with a dictionary it is in.
    """
    labelled = labelled.where("text is not null and text <> '' and label is not null")
    each = labelled.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label")).withColumn("key", F.xxhash64("text", F.lit(5)))
    total = labelled.select(F.count("*").alias("n"), F.avg("label").alias("p")).first()
    if not total["n"]:
        return Model()
    chance = F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    rows = keep(each.where(chance < min(1.0, fit_rows / total["n"])).withColumn("fold", F.pmod("key", F.lit(2)).cast("int")))
    if rows.select("label").distinct().count() < 2:
        return Model(prior=float(total["p"]))
    pieces = _pieces(rows, dict_input)
    parts = {(f, c): pieces.get((f, c), []) for f in (0, 1) for c in (0, 1)}
    both = {c: dictionary(parts[0, c] + parts[1, c]) for c in (0, 1)}
    # a fold is measured with the other's dictionaries; with all where the other lacks a label
    pair = {f: Model(dictionary(parts[1 - f, 1]), dictionary(parts[1 - f, 0])) if parts[1 - f, 1] and parts[1 - f, 0] else Model(both[1], both[0]) for f in (0, 1)}
    shared = rows.sparkSession.sparkContext.broadcast(pair)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [shared.value[f].measures(t.encode()) for f, t in zip(batch["fold"], batch["text"], strict=True)]
            yield pd.DataFrame({"key": batch["key"], "a": [g[0] for g in got], "b": [g[1] for g in got], "label": batch["label"]})

    got = rows.mapInPandas(measure, "key long, a double, b double, label int").toPandas().sort_values("key")
    w = calibrated(got[["a", "b"]].to_numpy(), got["label"].to_numpy(np.float64))
    return Model(both[1], both[0], w[:2], float(w[2]), float(total["p"]))


def score(docs: DataFrame, model: Model, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (which has these two and text), from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            value = np.array([shared.value.score((t.as_py() or "").encode()) for t in text], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Learns from labelled rows whose crc32(doc_id) mod 3 is not 1. Several
    labels of one doc_id count as 1 if their mean is at least a half; null
    labels and labels without a document are not used. A null doc_id has no
    label and no remainder (held_out is null). Null text counts as empty; an
    empty text gets the share of label 1 among the learned rows. With one label
    only, all texts get that share; with none, 0.5. Repeated rows are scored
    each, empty tables give no rows. Texts are read whole, in pieces; other
    columns, of whatever names, are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "text")
    marks = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    return score(base, learn(base.where("not held_out").join(marks, "doc_id").select("text", "label"), fit_rows=fit_rows), threshold=threshold)
