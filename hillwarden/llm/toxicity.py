"""Toxicity by weak supervision: many lexicon voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.near_dup import near_duplicates
from hillwarden.llm.tables import keep, row_key

WORD = re.compile(r"\w+")
STEMS = (4, 5, 6)  # lengths of word beginnings that may become voters


def signs(text: str) -> set[str]:
    """Whole words (with an end mark) and beginnings of words, lower case, each once."""
    words = set(WORD.findall(text.lower()))
    out = {w + "$" for w in words}
    for n in STEMS:
        out.update({w[:n] for w in words if len(w) >= n})
    return out


@dataclass
class Model:
    """Voters and the weights of the linear classifier over their votes."""

    voters: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    any_weight: float = 0.0
    bias: float = -6.0

    def __post_init__(self) -> None:
        self.place = {v: i for i, v in enumerate(self.voters)}
        by_length: dict[int, set[str]] = {}
        for v in self.voters:
            by_length.setdefault(-1 if v.endswith("$") else len(v), set()).add(v.rstrip("$"))
        self.whole = by_length.pop(-1, set())
        self.stems = sorted(by_length.items())

    def votes(self, text: str) -> list[int]:
        words = set(WORD.findall(text.lower()))
        out = [self.place[w + "$"] for w in words & self.whole]
        for n, known in self.stems:
            out += [self.place[s] for s in {w[:n] for w in words} & known]
        return out

    def score(self, text: str) -> float:
        v = self.votes(text)
        x = self.bias + self.weights[v].sum() + self.any_weight * (len(v) > 0)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def label_model(votes: np.ndarray, prior: np.ndarray, fire: np.ndarray, *, rounds: int = 20, trust: float = 30.0) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each row's label, and each voter's independence weight, by expectation maximisation.

    votes: rows by voters, 1 where a voter fires; one that does not abstains.
    One more voter votes for the clean class where all abstain. prior: the
    classes' shares. fire[c]: first estimate of each voter's chance to fire in
    class c, held with `trust` pseudo-rows. Voters that fire together within
    the positive class share their evidence: a voter's weight is one over one
    plus its strong correlations (over 0.6) with the others.
    """
    rows, m = votes.shape
    x = np.column_stack([votes, ~votes.any(axis=1)]).astype(np.float64)
    silent = np.clip([[x[:, -1].mean() / prior[0] if prior[0] else 1.0], [0.05]], 0.01, 0.99)
    theta, share = np.column_stack([fire, silent]), prior.copy()
    start = theta.copy()
    weight = np.ones(m + 1)
    post = np.zeros(rows)
    for r in range(rows and rounds):
        z = np.log(share[1]) - np.log(share[0]) + x @ (weight * (np.log(theta[1]) - np.log(theta[0])))
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for c, p in ((1, post), (0, 1 - post)):
            theta[c] = np.clip((x.T @ p + trust * start[c]) / (p.sum() + trust), 1e-5, 1 - 1e-5)
        share = np.clip(np.array([1 - post.mean(), post.mean()]), 1e-4, 1)
        if r == 2:
            p = post / max(post.sum(), 1e-9)
            mean = p @ x
            cov = (x * p[:, None]).T @ x - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            tied = np.clip(cov / np.outer(sd, sd), 0, 1)
            np.fill_diagonal(tied, 0)
            weight = 1 / (1 + np.where(tied > 0.6, tied, 0).sum(axis=1))
    return post, weight[:m]


def linear(votes: np.ndarray, target: np.ndarray, *, ridge: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels: weights of the voters, of any vote, and the bias."""
    x = np.column_stack([votes.astype(np.float64), votes.any(axis=1), np.ones(len(votes))])
    w = np.zeros(x.shape[1])
    w[-1] = -4.0
    hold = np.full(x.shape[1], ridge)
    hold[-2:] = ridge / 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(hold), x.T @ (target - p) - hold * w)
        size = np.abs(step).max()
        w += step * min(1.0, 4.0 / max(size, 1e-9))
        if size < 1e-5:
            break
    return w


def distinct(rows: DataFrame) -> DataFrame:
    """One row (text, toxic) of each near-duplicate class of rows; its label is 1 if at least half of the class's rows have it."""
    each = keep(rows.groupBy("text").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).withColumn("doc_id", F.xxhash64("text")))
    classes = near_duplicates(each.select("doc_id", "text")).select("doc_id", "class_id", "kept")
    each = keep(each.join(classes, "doc_id"))
    label = each.groupBy("class_id").agg((2 * F.sum("bad") >= F.sum("n")).cast("int").alias("toxic"))
    return each.where("kept").select("class_id", "text").join(label, "class_id").select("text", "toxic")


def learn(labelled: DataFrame, *, fit_rows: int = 20_000, max_voters: int = 400, least: int = 3, precision: float = 0.6) -> Model:
    """Model from a bounded sample (`fit_rows` in expectation, by hash) of rows with text and toxic 0/1.

    Words and beginnings of words that stand in at least `least` rows labelled
    1, are that precise and are tied to the label beyond chance become voters. The label model sees votes only.
    With no row of either label, nothing is called toxic.
    """
    labelled = labelled.where("toxic is not null and text is not null")
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    chance = F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(chance < min(1.0, fit_rows / total)).select("text", "toxic")
    # near copies of one text count once, or all its words would look like voters
    sample = keep(distinct(sample))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 500):
                seen: dict[str, list[int]] = {}
                for text, toxic in zip(batch["text"].iloc[i : i + 500], batch["toxic"].iloc[i : i + 500], strict=True):
                    for s in signs(text):
                        seen.setdefault(s, [0, 0])[int(toxic)] += 1
                yield pd.DataFrame([(s, a, b) for s, (a, b) in seen.items()], columns=["sign", "clean", "bad"])

    base = sizes[1] / total
    counts = sample.mapInPandas(count, "sign string, clean long, bad long").groupBy("sign").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    # precision is judged with the classes' true odds, shrunk towards them
    n = F.col("bad") + F.col("clean")
    exact = (F.col("bad") + base) / (n + 1.0)
    gain = F.col("bad") * F.log(F.col("bad") / n / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - base))).otherwise(0.0)
    counts = keep(counts.where(n >= least))
    chance = float(np.log(max(1, counts.count())))  # of so many signs, some stand in bad rows alone by chance
    chosen = counts.where((F.col("bad") >= least) & (exact >= precision) & (gain > chance)).orderBy(F.desc("bad"), "clean", "sign").limit(max_voters).toPandas()
    if not len(chosen):
        return Model()
    first = Model(chosen["sign"].tolist(), np.zeros(len(chosen)))
    shared = sample.sparkSession.sparkContext.broadcast(first)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield pd.DataFrame({"v": [own.votes(t) for t in batch["text"]], "toxic": batch["toxic"].astype("int32")})

    got = sample.mapInPandas(vote, "v array<int>, toxic int").toPandas()
    votes = np.zeros((len(got), len(chosen)), np.uint8)
    for i, v in enumerate(got["v"]):
        votes[i, np.asarray(v, np.int64)] = 1
    bad = max(1, int((got["toxic"] == 1).sum()))
    fire = np.clip(np.array([(chosen["clean"] + 0.1) / (len(got) - bad + 1), (chosen["bad"] + 0.1) / (bad + 1)], dtype=float), 1e-5, 1 - 1e-5)
    post, _ = label_model(votes, np.array([1 - base, base]), fire)
    w = linear(votes, post)
    return Model(first.voters, w[:-2], float(w[-2]), float(w[-1]))


def score(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (which has held_out), from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            value = np.fromiter((own.score(t.as_py() or "") for t in batch.column("text")), np.float64, batch.num_rows)
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text") + ", score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """doc_id, rk (row key), held_out, score, predicted for every row of docs.

    Learns from labelled rows whose crc32(doc_id) mod 3 is not 1. Several
    labels of one doc_id count as 1 if their mean is at least a half; null
    labels and labels without a document are not used. A null doc_id has no
    label and no remainder (held_out is null). Null text counts as empty.
    Repeated rows are scored each. Texts are read whole; other columns are not.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rk"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "text")
    toxic = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    return score(base, learn(base.where("not held_out").select("doc_id", "text").join(toxic, "doc_id"), fit_rows=fit_rows), threshold=threshold)
