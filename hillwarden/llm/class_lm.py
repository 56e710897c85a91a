"""Class-based n-gram language model: exchange clustering, class transitions and word emissions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep
from hillwarden.llm.words import SOLID, groups_of, list_column, spans, text_bytes, word_hashes

SHAPES = 64
SHAPE_SHIFT = np.uint64(58)
END = np.uint64(1)  # key of the end of a text
CHUNK = 1 << 20
PAIRS = 1 << 21  # pairs of symbols counted together


def token_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key of each token (words, then an end for each text) and where each text's begin.

    The high six bits of a key are the word's shape: its last letter and its
    length in steps. Words of a shape that were never met form a class.
    """
    starts, ends, first = spans(data, at, SOLID)
    code = word_hashes(data, starts, ends)
    if len(starts):
        last = data[ends - 1].astype(np.uint64)
        long = np.minimum((ends - starts) // 4, 3).astype(np.uint64)
        shape = (last % np.uint64(16)) * np.uint64(4) + long
        code = (code & np.uint64((1 << 58) - 1)) | (shape << SHAPE_SHIFT)
        code[code <= END] += np.uint64(2)
    keys = np.insert(code, first[1:], END)
    return keys, first + np.arange(len(at))


@dataclass
class Lexicon:
    """The words counted most often, for lookups without a shuffle: keys, counts and cluster symbols."""

    keys: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray  # number of a clustered word, or -1

    def __post_init__(self) -> None:
        size = 1 << max(10, int(2 * max(1, len(self.keys))).bit_length() + 1)
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.table = np.full(size, -1, np.int32)
        order = np.argsort(self.counts, kind="stable")  # frequent words win a shared slot
        self.table[self._slot(self.keys[order])] = order

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = self.table[self._slot(keys)].astype(np.int64)
        wrong = np.flatnonzero((place >= 0) & (self.keys[place] != keys))
        i = np.minimum(np.searchsorted(self.keys, keys[wrong]), len(self.keys) - 1)
        place[wrong] = np.where(self.keys[i] == keys[wrong], i, -1)
        return place

    def classify(self, keys: np.ndarray, place: np.ndarray, clustered: int) -> np.ndarray:
        """Symbol of each token: a clustered word's own, else one for its shape."""
        known = np.where(place >= 0, self.symbols[place], -1) if len(self.keys) else np.full(len(keys), -1)
        return np.where(known >= 0, known, clustered + (keys >> SHAPE_SHIFT).astype(np.int64))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, at = text_bytes(batch.column("text"))
    for i, j in groups_of(at, CHUNK):
        yield i, j, *token_keys(data[at[i] : at[j]], at[i : j + 1] - at[i])


def word_counts(train: DataFrame) -> DataFrame:
    """key and c of every token of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, keys, _ in _chunks(batch):
                key, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "c"])

    return train.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> tuple[Lexicon, int]:
    """Lexicon of the words with the highest counts, `most` at most besides the end, and the count below which words are left out."""
    steps = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(1 << 16).collect()
    total, floor = 0, 1 << 62
    for r in steps:
        if total + r["n"] > most:
            break
        total, floor = total + r["n"], r["c"]
    got = counts.where((F.col("c") >= floor) | (F.col("key") == int(END))).toPandas()
    keys = got["key"].to_numpy(np.int64).view(np.uint64) if len(got) else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], got["c"].to_numpy(np.int64)[order], np.full(len(keys), -1, np.int64)), floor


def symbol_pairs(train: DataFrame, lexicon: Lexicon, clustered: int) -> DataFrame:
    """u, v, n: how often symbol v follows symbol u; each text starts after an end."""
    shared = train.sparkSession.sparkContext.broadcast(lexicon)
    width = clustered + SHAPES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        end = int(own.classify(np.array([END]), own.find(np.array([END])), clustered)[0])
        held = []

        def counted() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])

        for batch in batches:
            for _, _, keys, begin in _chunks(batch):
                v = own.classify(keys, own.find(keys), clustered)
                u = np.empty_like(v)
                u[1:] = v[:-1]
                u[begin[:-1]] = end
                held.append(u * width + v)
                if sum(map(len, held)) > PAIRS:
                    yield counted()
        yield counted()

    sums = train.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return sums.select(F.expr(f"code div {width}").cast("int").alias("u"), (F.col("code") % width).cast("int").alias("v"), "n")


def _flow(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def neighbours(pairs: DataFrame, clustered: int, words: int, block: int = 1 << 19) -> DataFrame:
    """kind, ahead and behind: the symbols after and before each symbol and how often, as arrays of many words in one binary value.

    kind is 0 for the `clustered` most frequent words, 1 for other words and 2
    for symbols of shapes. Rounds read these rows again and again, so they
    are laid out for numpy.
    """
    ahead = pairs.groupBy(F.col("u").alias("w")).agg(F.collect_list("v").alias("next"), F.collect_list("n").alias("next_n"))
    behind = pairs.groupBy(F.col("v").alias("w")).agg(F.collect_list("u").alias("prev"), F.collect_list("n").alias("prev_n"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column("w").to_numpy().astype(np.int64)
            kind = (w >= clustered).astype(int) + (w >= words)
            sizes = sum(np.nan_to_num(batch.column(c).value_lengths().to_numpy(zero_copy_only=False)) for c in ("next", "prev"))
            lot = kind + 3 * (np.cumsum(sizes) // block).astype(np.int64)
            for x in np.unique(lot):
                part = batch.filter(pa.array(lot == x))
                row = []
                for side in ("next", "prev"):
                    lens = np.nan_to_num(part.column(side).value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                    syms, n = (part.column(c).flatten().to_numpy() for c in (side, f"{side}_n"))
                    row.append(b"".join(v.astype(t).tobytes() for v, t in ((np.array([len(lens)]), "i8"), (w[lot == x], "i8"), (lens, "i8"), (n, "i8"), (syms, "i4"))))
                yield pa.RecordBatch.from_arrays([pa.array([int(x % 3)], pa.int32()), *[pa.array([v], pa.binary()) for v in row]], names=["kind", "ahead", "behind"])

    return keep(ahead.join(behind, "w", "full").mapInArrow(pack, "kind int, ahead binary, behind binary"))


def _unpack(value: bytes) -> tuple[np.ndarray, ...]:
    """w, and for each neighbour the place of its word, symbol and count."""
    m = int(np.frombuffer(value, "i8", 1)[0])
    w, lens = np.frombuffer(value, "i8", 2 * m, 8).reshape(2, m)
    e = int(lens.sum())
    return w, np.repeat(np.arange(m), lens), np.frombuffer(value, "i4", e, 8 + 16 * m + 8 * e), np.frombuffer(value, "i8", e, 8 + 16 * m)


def class_table(rows: DataFrame, of: np.ndarray, to: np.ndarray, total: int) -> np.ndarray:
    """How often a class follows a class, if u counts for class of[u] and v for class to[v]; -1 is left out."""
    shared = rows.sparkSession.sparkContext.broadcast((of, to))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, (left, right) = np.zeros(total * total), shared.value
        for batch in batches:
            for value in batch.column("ahead"):
                w, word, v, n = _unpack(value.as_py())
                a, b = left[w][word], right[v]
                ok = (a >= 0) & (b >= 0)
                sums += np.bincount(a[ok] * total + b[ok], n[ok], total * total)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at // total), pa.array(at % total), pa.array(sums[at].astype(np.int64))], names=["a", "b", "n"])

    got = rows.select("ahead").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((total, total))
    out[got["a"], got["b"]] = got["n"]
    return out


def exchange(rows: DataFrame, shapes: np.ndarray, clustered: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol and the class transition counts.

    `shapes` has the shape of each word. The `clustered` most frequent words
    start in classes dealt by frequency, all others in a class of their shape,
    as do the symbols of shapes, which stay there. For `rounds` rounds the
    first are exchanged, then, for as many, all words. Each round every word
    of one half is tried in every class with the others held fixed and goes
    where the corpus is likeliest. A word's neighbours are stored together
    (`rows`, see `neighbours`), so words are tried in parallel; only the
    classes of the words, and sums over classes, come to the driver.
    """
    spark = rows.sparkSession
    total, words = classes + SHAPES, len(shapes)
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(SHAPES)]).astype(np.int64)
    of[clustered:words] = classes + shapes[clustered:]
    counts = class_table(rows, of, of, total)
    for kinds in (1, 2) if words > clustered else (1,):
        for r in range(rounds):
            shared = spark.sparkContext.broadcast((of, counts))

            def move(batches: Iterator[pa.RecordBatch], half: int = r % 2, shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
                own, full = shared.value
                for batch in batches:
                    for values in zip(batch.column("ahead"), batch.column("behind"), strict=True):
                        words, sides = [], []
                        for value in values:
                            w, word, sym, n = _unpack(value.as_py())
                            tried = (w * 0x9E3779B1 >> 7) % 2 == half
                            place, on = np.cumsum(tried) - 1, tried[word]
                            sides.append(_sparse(place[word[on]], own[sym[on]], n[on].astype(float), total))
                            words = w[tried]
                        best = best_classes(full, own[words], *sides, classes)
                        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(best)], names=["w", "c"])

            got = rows.where(F.col("kind") < kinds).mapInArrow(move, "w long, c long").toPandas()
            changed = int((of[got["w"]] != got["c"]).sum())
            of = of.copy()
            of[got["w"]] = got["c"]
            counts = class_table(rows, of, of, total)
            if not changed and r:
                break
    return of, counts


Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]  # word, class and count, in order of words


def _sparse(word: np.ndarray, k: np.ndarray, n: np.ndarray, total: int) -> Sparse:
    code, at = np.unique(word * total + k, return_inverse=True)
    return code // total, code % total, np.bincount(at, n, len(code))


def best_classes(full: np.ndarray, now: np.ndarray, out: Sparse, into: Sparse, classes: int, block: int = 512) -> np.ndarray:
    """Class in which each word (now in class `now`, followed by classes as in `out`, after those in `into`) makes the class bigrams likeliest.

    Words are tried one by one: each is first taken out of the counts `full`.
    It stays where it is unless another class gains. The classes of shapes
    take no words in, so one that has no class yet gets the best there is.
    """
    best = np.empty(len(now), np.int64)
    for i in range(0, len(now), block):
        j = min(len(now), i + block)
        own, at = now[i:j], np.arange(j - i)
        sides = []
        for word, k, n in (out, into):
            a, b = np.searchsorted(word, [i, j])
            sides.append((word[a:b] - i, k[a:b], n[a:b]))
        dense = [np.zeros((j - i, len(full))) for _ in sides]
        for d, (word, k, n) in zip(dense, sides, strict=True):
            d[word, k] = n
        gain = np.zeros((j - i, classes))
        home = own < classes
        for counts, (word, k, n), other in ((full, sides[0], dense[1]), (full.T, sides[1], dense[0])):
            rest = counts[:classes, k].T.copy()
            same = k == own[word]
            rest[same] -= other[word[same], :classes]
            e = np.flatnonzero(home[word])
            rest[e, own[word[e]]] -= n[e]
            np.maximum(rest, 0, out=rest)
            more = _flow(rest + n[:, None]) - _flow(rest)
            if len(word):
                first = np.flatnonzero(np.diff(word, prepend=-1))
                gain[word[first]] += np.add.reduceat(more, first)
            mine = np.bincount(word, n, j - i)[:, None]
            sums = np.repeat(counts.sum(1)[None, :classes], j - i, 0)
            sums[at[home], own[home]] -= mine[home, 0]
            gain -= _flow(sums + mine) - _flow(sums)
        # a class after itself takes both sides at once
        o, n = (d[:, :classes] for d in dense)
        rest = np.repeat(np.diag(full)[None, :classes], j - i, 0)
        rest[at[home], own[home]] -= (o + n)[at[home], own[home]]
        np.maximum(rest, 0, out=rest)
        gain += _flow(rest + o + n) - _flow(rest + o) - _flow(rest + n) + _flow(rest)
        top = gain.argmax(1)
        stay = home & (gain[at, top] <= gain[at, np.where(home, own, 0)] + 1e-9)
        best[i:j] = np.where(stay, own, top)
    return best


def rare_words(train: DataFrame, lexicon: Lexicon, of: np.ndarray, counts: np.ndarray, classes: int) -> DataFrame:
    """key, c, class k and neighbours of each training word outside the lexicon, in the class its neighbours make likeliest.

    A neighbour is code, its class (plus the number of classes if it follows),
    and other, its key if it is outside the lexicon itself, else 0.
    """
    shared = train.sparkSession.sparkContext.broadcast((lexicon, of, counts))
    total = len(counts)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, by, _ = shared.value
        for batch in batches:
            for _, _, keys, begin in _chunks(batch):
                place = own.find(keys)
                k = by[own.classify(keys, place, len(own.keys))]
                other = np.where(place < 0, keys, np.uint64(0)).view(np.int64)
                end = by[own.classify(np.array([END]), own.find(np.array([END])), len(own.keys))[0]]
                at = np.flatnonzero(place < 0)  # never the end, so a next one is there
                first = np.zeros(len(keys), bool)
                first[begin[:-1]] = True
                before, beside = np.where(first[at], end, k[at - 1]), np.where(first[at], 0, other[at - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.tile(keys[at].view(np.int64), 2), np.r_[before, total + k[at + 1]], np.r_[beside, other[at + 1]])],
                    names=["key", "code", "other"],
                )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, full = shared.value
        for batch in batches:
            key, lists = batch.column("key").to_numpy(), batch.column("code")
            word, code = np.repeat(np.arange(len(key)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            back = code < total
            side = lambda on: _sparse(word[on], code[on] % total, np.ones(int(on.sum())), total)
            now = classes + (key.view(np.uint64) >> SHAPE_SHIFT).astype(np.int64)
            k = best_classes(full, now, side(~back), side(back), classes)
            c = np.bincount(word, back, len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(c), pa.array(k), lists, batch.column("other")], names=["key", "c", "k", "code", "other"])

    met = train.select("text").mapInArrow(tokens, "key long, code long, other long")
    lists = met.groupBy("key").agg(F.collect_list("code").alias("code"), F.collect_list("other").alias("other"))
    return keep(lists.mapInArrow(best, "key long, c long, k long, code array<bigint>, other array<bigint>"))


@dataclass
class Model:
    lexicon: Lexicon
    clustered: int
    of: np.ndarray  # class of each symbol
    step: np.ndarray  # log10 chance of a class after a class
    mass: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct training words of each class
    tokens: int
    words: int

    def emission(self, c: np.ndarray, k: np.ndarray, delta: float) -> np.ndarray:
        """log10 chance of a word with count c in class k; each class has one share for words never met."""
        return np.log10((c + delta) / (self.mass[k] + delta * (self.kinds[k] + 1)))


def learn(train: DataFrame, *, clustered: int = 4096, classes: int = 64, most: int = 1 << 18, rounds: int = 6) -> tuple[Model, DataFrame]:
    """Model, and key, c and class k of each training word outside the model's lexicon.

    Every word is in a class by its neighbours. The classes of shapes stand
    for words never met: a word met once counts in its own class and once more
    in that of its shape.
    """
    counts = keep(word_counts(train))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    lexicon, _ = frequent(counts, most)
    order = np.argsort(-lexicon.counts, kind="stable")
    lexicon.symbols[order] = np.arange(len(order))
    words, total = len(order), classes + SHAPES
    shapes = (lexicon.keys[order] >> SHAPE_SHIFT).astype(np.int64)
    rows = neighbours(keep(symbol_pairs(train, lexicon, words)), clustered, words)
    of, flow = exchange(rows, shapes, clustered, classes, rounds)
    rare = rare_words(train, lexicon, of, flow, classes)

    # transitions to and from rare words, in the classes these have now
    known = np.where(np.arange(len(of)) < words, of, -1)
    seen = class_table(rows, known, known, total)
    beside = rare.select("key", "c", "k", F.explode(F.arrays_zip("code", "other")).alias("x")).select("key", "c", "k", "x.code", "x.other")
    for r in beside.where("other = 0").groupBy("k", "code").agg(F.count("*").alias("n")).collect():
        seen[(r["code"], r["k"]) if r["code"] < total else (r["k"], r["code"] - total)] += r["n"]
    both = beside.where(f"other <> 0 AND code >= {total}").select("k", F.col("other").alias("key")).join(rare.select("key", F.col("k").alias("k2")), "key")
    for r in both.groupBy("k", "k2").agg(F.count("*").alias("n")).collect():
        seen[r["k"], r["k2"]] += r["n"]

    # what stands for words never met
    once = np.r_[np.where(lexicon.counts[order] == 1, classes + shapes, -1), np.full(SHAPES, -1)]
    new = class_table(rows, of, once, total) + class_table(rows, once, of, total)
    shape = F.shiftrightunsigned("key", 58).alias("s")
    for r in beside.where("c = 1").groupBy(shape, "code").agg(F.count("*").alias("n")).collect():
        s = classes + r["s"]
        new[(r["code"], s) if r["code"] < total else (s, r["code"] - total)] += r["n"]
    flow = seen + new

    mass, kinds = seen.sum(0), np.bincount(of[:words], minlength=total).astype(float)
    mass[classes:] += new.sum(0)[classes:]
    for r in rare.groupBy("k").agg(F.count("*").alias("n")).collect():
        kinds[r["k"]] += r["n"]
    kinds[classes:] += new.sum(0)[classes:]
    alone = (mass + 0.5) / (mass.sum() + 0.5 * total)
    own = flow.sum(1)
    follow = (flow > 0).sum(1)
    hold = (own / np.maximum(1, own + follow))[:, None]  # share of the bigram, by how many classes follow
    step = np.log10(hold * flow / np.maximum(1, own)[:, None] + (1 - hold) * alone[None, :])
    return Model(lexicon, words, of, step, mass, kinds, int(sums["n"]), int(sums["v"])), rare.select("key", "c", "k")


def score(docs: DataFrame, model: Model, rare: DataFrame, *, delta: float = 0.5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs (which has held_out).

    What lies between words of the lexicon is scored where the text is read.
    Other words get their counts and classes by a join, and are then scored
    text by text, with the classes of the words beside them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    norm = float(np.log10(model.tokens + model.words + 1))
    classes = len(model.step) - SHAPES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, number = shared.value, TaskContext.get().partitionId() << 36
        lex = own.lexicon
        end = own.of[lex.classify(np.array([END]), lex.find(np.array([END])), own.clustered)[0]]
        for batch in batches:
            for i, j, keys, begin in _chunks(batch):
                n = np.diff(begin)
                owner = np.repeat(np.arange(j - i), n)
                place = lex.find(keys)
                known = place >= 0
                k = own.of[lex.classify(keys, place, own.clustered)]
                before = np.empty_like(k)
                before[1:] = np.where(known[:-1], k[:-1], -1)
                before[begin[:-1]] = end
                after = np.empty_like(k)
                after[:-1] = np.where(known[1:], k[1:], -1)
                after[begin[1:] - 1] = -1
                c = np.where(known, lex.counts[place], 0) if len(lex.keys) else np.zeros(len(keys), np.int64)
                term = np.where(known, own.emission(c, k, delta) + np.where(before >= 0, own.step[before, k], 0), 0)
                base = np.where(known, np.log10(c + 1.0) - norm, 0)
                at = np.flatnonzero(~known)
                cut = np.searchsorted(owner[at], np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + j - i)), batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i),
                        pa.array(n.astype(np.int64)), *[pa.array(np.add.reduceat(x, begin[:-1])) for x in (known.astype(np.int64), base, term)],
                        list_column(keys[at].view(np.int64), cut, pa.int64()), *[list_column(x[at].astype(np.int32), cut, pa.int32()) for x in (before, after)],
                    ],
                    names=["rid", "doc_id", "held_out", "n_tokens", "known", "base", "total", "key", "before", "after"],
                )
                number += j - i

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lists = batch.column("x")
            _, k, c, before, after = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            first = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())[:-1]]
            prior = np.where(before >= 0, before, np.r_[0, k[:-1]])  # else the word before is the entry before
            term = own.step[prior, k] + own.emission(c, k, delta) + np.where(after >= 0, own.step[k, after], 0)
            sums = [np.add.reduceat(x, first) for x in ((c > 0).astype(np.int64), np.log10(c + 1.0) - norm, term)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), *map(pa.array, sums)], names=["rid", "known2", "base2", "total2"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    schema = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, total double, key array<bigint>, before array<int>, after array<int>"
    rows = keep(texts.mapInArrow(run, schema))
    words = rows.select("rid", F.posexplode(F.arrays_zip("key", "before", "after")).alias("pos", "x")).select("rid", "pos", "x.*")
    shape = (F.lit(classes) + F.shiftrightunsigned("key", 58)).cast("long")
    words = words.join(rare, "key", "left").select(
        "rid", F.struct("pos", F.coalesce("k", shape).alias("k"), F.coalesce("c", F.lit(0).cast("long")).alias("c"), "before", "after").alias("x")
    )
    more = words.groupBy("rid").agg(F.sort_array(F.collect_list("x")).alias("x")).mapInArrow(rest, "rid long, known2 long, base2 double, total2 double")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return rows.drop("key", "before", "after").join(more, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", add("known", "known2").cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        add("base", "base2").alias("base_score"), add("total", "total2").alias("score"),
    )


def _out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 7 == 2


def class_scores(docs: DataFrame, *, clustered: int = 4096, classes: int = 64, most: int = 1 << 18, rounds: int = 6) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 7 is not 2 and scores every row with the class model.

    Counts cover all training tokens, and every training word is in a class
    by its neighbours: the `clustered` most frequent words are exchanged
    first, then all of the `most` words that are looked up without a shuffle,
    and each of the others goes to the class that is best for it. Words never
    met share a class by shape.

    Null text counts as empty: one token, the end. A null doc_id has no
    remainder: such rows are scored, not learned from, and held_out is null.
    Repeated rows are learned from and scored each. With no training row all
    counts are zero. Texts are read whole; other columns are not.
    """
    docs = docs.select("doc_id", "text", _out().alias("held_out"))
    model, rare = learn(docs.where("not held_out"), clustered=clustered, classes=classes, most=most, rounds=rounds)
    return score(docs, model, rare)
