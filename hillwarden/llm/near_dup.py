"""Near-duplicate detection: ProbMinHash signatures, banding, exact verification, connected classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import bitmap, bits_for, keep, probe, row_key, slot_of
from hillwarden.llm.words import ALNUM, groups_of, list_column, mixed, spans, text_bytes, word_hashes

BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingles(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each text, sorted within it, their counts, and where each text's begin.

    A text of fewer words has one shingle of all its words.
    """
    starts, ends, first = spans(data, at, ALNUM)
    words = word_hashes(data, starts, ends)
    n = np.diff(first)
    m = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(n)), m)
    begin = np.concatenate([[0], np.cumsum(m)])
    place = np.arange(begin[-1]) - begin[owner] + first[owner]
    code = np.zeros(len(place), np.uint64)
    for j in range(k):
        inside = place + j < first[owner + 1]
        w = np.where(inside, words[np.minimum(place + j, max(0, len(words) - 1))] if len(words) else 0, np.uint64(j + 1))
        code = mixed(code * ODD[0] + w)
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    at_new = np.flatnonzero(new)
    count = np.diff(np.append(at_new, len(code)))
    return code[at_new], count, np.searchsorted(owner[at_new], np.arange(len(n) + 1))


def signatures(code: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """SIZE registers per text. A register's chance to agree between two texts is their probability Jaccard.

    Each element is a Poisson process of its
    weight's rate; an arrival falls into a random register, which keeps the
    element of its first arrival. Arrivals of all texts are drawn round by
    round; an element whose next arrival is later than all registers of its
    text is done.
    """
    texts = len(begin) - 1
    first = np.full(texts * SIZE, np.inf)
    kept = np.zeros(texts * SIZE, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(begin))
    rate = weight
    when = np.zeros(len(code))
    element = code
    live = np.arange(len(code))
    step = 0
    while len(live):
        step += 1
        draw = mixed(element + np.uint64(step * int(ODD[1]) % (1 << 64)))
        when = when - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / rate
        place = owner * SIZE + (mixed(draw ^ ODD[2]) % np.uint64(SIZE)).astype(np.int64)
        better = np.flatnonzero(when < first[place])
        if len(better):
            p, t, e = place[better], when[better], element[better]
            order = np.lexsort((-t, p))  # of equal places the earliest is written last
            p, t, e = p[order], t[order], e[order]
            first[p], kept[p] = t, e
        if step % 4 == 1 or step < 4:
            last = first.reshape(texts, SIZE).max(axis=1)
            live = np.flatnonzero(when < last[owner])
            element, owner, rate, when = element[live], owner[live], rate[live], when[live]
    return mixed(kept ^ ODD[3]).reshape(texts, SIZE)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """Per row: rid, doc_id, rk, same (digest of the shingle set), bands, sig (16 bits of each register), shingles (32 bits each, sorted).

    Links are defined by sets, so all distinct shingles weigh the same: their
    probability Jaccard is the sets' Jaccard similarity, and registers estimate
    what verification measures.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for i, j in groups_of(at, 1 << 20):
                part = batch.slice(i, j - i)
                own, cut = data[at[i] : at[j]], at[i : j + 1] - at[i]
                code, _, begin = shingles(own, cut, k)
                sig = signatures(code, np.ones(len(code)), begin)
                bands = np.zeros((j - i, BANDS), np.uint64)
                for r in range(ROWS):
                    bands = mixed(bands * ODD[4] + sig[:, r::ROWS])
                bands = mixed(bands ^ (np.arange(BANDS, dtype=np.uint64) * ODD[5]))
                size = np.diff(begin)
                heap = np.concatenate([[np.uint64(0)], np.cumsum(mixed(code + ODD[6]))])
                same = mixed(heap[begin[1:]] - heap[begin[:-1]] + size.astype(np.uint64))
                bare = np.flatnonzero(size == 0)  # no word: equal only to the same text
                for b in bare.tolist():
                    same[b] = word_hashes(own, cut[b : b + 1], cut[b + 1 : b + 2])[0]
                small = (code >> np.uint64(32)).astype(np.uint32)
                count_bands = np.where(size > 0, BANDS, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + j - i)), part.column("doc_id"), part.column("rk"), pa.array(same.view(np.int64)),
                        list_column(bands[size > 0].ravel().view(np.int64), np.concatenate([[0], np.cumsum(count_bands)]), pa.int64()),
                        pa.array([s.tobytes() for s in (sig >> np.uint64(48)).astype("<u2")], pa.binary()),
                        pa.array([small[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary()),
                    ],
                    names=["rid", "doc_id", "rk", "same", "bands", "sig", "shingles"],
                )
                number += j - i

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rk"), "text")
    return rows.mapInArrow(run, "rid long, doc_id long, rk long, same long, bands array<bigint>, sig binary, shingles binary")


def _agree(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, x, y: signatures) whose registers agree as often as the threshold lets expect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<u2").reshape(-1, SIZE)
                y = np.frombuffer(b"".join(batch.column("y").to_pylist()), "<u2").reshape(-1, SIZE)
                ok = pa.array((x == y).mean(axis=1) >= threshold)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _jaccard(pairs: DataFrame) -> DataFrame:
    """Exact Jaccard similarity of pairs (a, b, x, y: sorted shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.unique(np.frombuffer(x.as_py(), np.uint32)), np.unique(np.frombuffer(y.as_py(), np.uint32))
                both = len(np.intersect1d(p, q, assume_unique=True))
                value.append(both / max(1, len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(np.array(value, np.float64))], names=["a", "b", "similarity"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, similarity double")


def _both(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    return pairs.join(side.select(F.col("rid").alias("a"), F.col(column).alias("x")), "a").join(side.select(F.col("rid").alias("b"), F.col(column).alias("y")), "b")


def verified(pairs: DataFrame, sketches: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b, similarity) among candidate pairs: first by registers, then by exact shingle sets.

    Only sketches that stand in a pair are shuffled; a bounded bitmap of their
    numbers keeps the others out.
    """
    pairs = keep(pairs)
    near = keep(_agree(_both(pairs, _only(sketches.select("rid", "sig"), pairs), "sig"), similarity - 0.2))
    links = _jaccard(_both(near, _only(rows.select("rid", "shingles"), near), "shingles"))
    return keep(links.where(F.col("similarity") >= similarity))


def _only(side: DataFrame, pairs: DataFrame) -> DataFrame:
    return _those(side, pairs.select(F.explode(F.array("a", "b")).alias("rid")), 2 * pairs.count())


def _those(side: DataFrame, ends: DataFrame, most: int) -> DataFrame:
    """Rows of side whose rid is among ends (of `most` rows at most), and a few others: what a bounded bitmap lets pass."""
    bits = bits_for(most)
    words = keep(bitmap(ends.select(slot_of(F.col("rid"), bits).alias("slot"))))
    return probe(side, slot_of(F.col("rid"), bits), words, "bm_hit").where("bm_hit").drop("bm_hit")


def components(links: DataFrame, limit: int = 60) -> DataFrame:
    """rid and comp (least rid it is linked to, over any number of steps), for every rid that has a link.

    Each round a row takes the least label of its neighbours, then its label's
    label; stars and short chains settle in a few rounds.
    """
    edges = keep(links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*").distinct())
    label = keep(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("comp")).select(F.col("u").alias("rid"), "comp"))
    for _ in range(limit):
        over = edges.join(label.withColumnRenamed("rid", "v"), "v").groupBy(F.col("u").alias("rid")).agg(F.min("comp").alias("near"))
        step = keep(label.join(over, "rid", "left").select("rid", F.least("comp", F.coalesce("near", "comp")).alias("new"), "comp"))
        jump = step.select(F.col("rid").alias("new"), F.col("new").alias("far"))
        after = keep(step.join(jump, "new", "left").select("rid", F.least("new", F.coalesce("far", "new")).alias("comp"), (F.least("new", F.coalesce("far", "new")) != F.col("comp")).alias("moved")))
        label = after.select("rid", "comp")
        if after.where("moved").limit(1).count() == 0:
            return label
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, *, k: int = 5, similarity: float = 0.8, small: int = 16) -> DataFrame:
    """One row per row of docs: doc_id, rk, class_id (least doc_id of its class), class_size, kept.

    Two texts are linked if the Jaccard similarity of their sets of k-word
    shingles is at least `similarity`; a class is what links connect. Rows
    with equal sets are one text from the start. Candidates share one of 25
    bands of five ProbMinHash registers.

    Pairs of a crowded bucket are never listed. First each text is compared with one
    pivot: of its buckets' members that which shares most buckets with others,
    so most of a group of copies, of any size, meets its original. In buckets
    that still hold several classes every pair of different classes is then
    compared: listed in buckets of up to `small` texts, in blocks inside tasks
    in larger ones (`_crowded`). So each pair that shares a bucket ends up in
    one class or has been compared.

    Null and empty texts, and others without words, are alike only if equal
    byte for byte (null as empty). Null doc_ids are ignored for class_id, which is
    null if a class has no other. Equal rows share a class; of each class one
    row has kept = true, that with the least doc_id. An empty table gives no
    rows. Texts are read whole; other columns, of whatever names, are not read.
    """
    rows = keep(sketch(docs, k))
    reps = keep(rows.groupBy("same").agg(F.min("rid").alias("rid")))
    sketches = keep(rows.select("rid", "bands", "sig").join(reps.select("rid"), "rid", "left_semi"))
    inside = sketches.select("rid", F.posexplode("bands").alias("band", "key"))
    members = keep(inside.join(inside.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"))

    # the text that shares most buckets with others is most likely what the rest was copied from
    central = keep(members.join(members.groupBy("rid").agg(F.sum("n").alias("c")), "rid").select("key", "rid", F.struct("c", _lot("rid", 0), "rid").alias("rank")))
    pivots = central.groupBy("key").agg(F.max("rank").alias("top"))
    first = central.select("key", "rid").join(pivots, "key").groupBy("rid").agg(F.max("top").getField("rid").alias("pivot")).where("rid != pivot")
    links = verified(_pair("rid", "pivot", first).distinct(), sketches, rows, similarity)
    label = components(links)

    def joined(found: DataFrame) -> bool:
        nonlocal links, label
        if found.limit(1).count() == 0:
            return False
        links = keep(links.select("a", "b").union(found.select("a", "b")))
        label = components(links)
        return True

    now = _mixed(members, label)
    few = now.where(F.col("n") <= small).groupBy("key").agg(F.collect_set(F.struct("comp", "rid")).alias("r"))
    cross = few.select(F.explode("r").alias("x"), "r").select("x", F.explode(F.expr("filter(r, y -> y.comp > x.comp)")).alias("y"))
    if now.limit(1).count() and joined(verified(_pair("x.rid", "y.rid", cross).distinct(), sketches, rows, similarity)):
        now = _mixed(now.drop("comp"), label)
    large = now.where(F.col("n") > small)
    if large.limit(1).count():
        joined(_crowded(large.drop("n"), rows, similarity))

    comp = rows.select("rid", "doc_id", "rk", "same").join(reps.withColumnRenamed("rid", "rep"), "same")
    comp = keep(comp.join(label.withColumnRenamed("rid", "rep"), "rep", "left").select("rid", "doc_id", "rk", F.coalesce("comp", "rep").alias("comp")))
    best = comp.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), "rid")).getField("rid").alias("first"))
    return comp.join(keep(best), "comp").select("doc_id", "rk", "class_id", "class_size", (F.col("rid") == F.col("first")).alias("kept"))


def _pair(a: str, b: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _mixed(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members (key, band, n, rid, comp) of the buckets that hold several classes."""
    now = keep(members.select("key", "band", "n", "rid").join(label, "rid", "left").withColumn("comp", F.coalesce("comp", "rid")))
    several = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return keep(now.join(several, "key"))


def _crowded(now: DataFrame, rows: DataFrame, similarity: float, block: int = 512, size: int = 1 << 22) -> DataFrame:
    """Links (a, b) that join all classes of a bucket between which a pair is similar enough; every such pair is compared.

    A bucket is cut into blocks of about `block` texts and `size` bytes of shingles: a class larger than that has blocks
    of its own, the smaller ones share blocks. Each two blocks, but not two of one class, are compared inside one task,
    which returns fewer links than it has texts, whatever the number of pairs.
    """
    members = now.join(_those(rows.select("rid", F.length("shingles").alias("w")), now.select("rid"), now.count()), "rid")
    cut = F.ceil(F.greatest(F.sum("n") / block, F.sum("w") / size)).cast("int")
    classes = keep(members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("w").alias("w")))
    own = classes.groupBy("key", "comp").agg(cut.alias("parts")).where("parts > 1")
    rest = classes.join(own, ["key", "comp"], "left_anti").groupBy("key").agg(cut.alias("shared"))
    plan = keep(classes.select("key", "comp").join(own, ["key", "comp"], "left").join(rest, "key", "left").select(
        "key", "comp", F.when(F.col("parts").isNotNull(), F.col("comp")).otherwise(F.lit(-1)).alias("of"), F.coalesce("parts", "shared").alias("parts")
    ))
    lot = F.when(F.col("of") < 0, _lot("comp", 30)).otherwise(_lot("rid", 31))
    members = keep(members.select("key", "band", "rid", "comp").join(plan, ["key", "comp"]).select(
        "key", "band", "rid", "comp", F.struct("of", F.pmod(lot, F.col("parts")).alias("part")).alias("block")
    ))
    blocks = keep(members.select("key", "block").distinct())
    left, right = blocks.withColumnRenamed("block", "p"), blocks.withColumnRenamed("block", "q")
    tasks = keep(left.join(right, "key").where("p <= q AND (p.of != q.of OR p.of < 0)"))
    sides = members.join(tasks, (members["key"] == tasks["key"]) & (members["block"] == tasks["p"])).select(members["*"], "p", "q", F.lit(0).alias("side")).union(
        members.join(tasks.where("p < q"), (members["key"] == tasks["key"]) & (members["block"] == tasks["q"])).select(members["*"], "p", "q", F.lit(1).alias("side"))
    )
    ends = keep(now.select("rid").distinct())
    # the shingles of all other texts stay where they are
    body = keep(_those(rows.select("rid", "bands", "sig", "shingles"), ends, ends.count()).join(ends, "rid"))
    whole = sides.drop("block").join(body, "rid")

    def run(table: pa.Table) -> pa.Table:
        return _compared(table, similarity)

    return keep(whole.groupBy("key", "p", "q").applyInArrow(run, "a long, b long"))


def _compared(table: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) between classes of one bucket's texts (rid, comp, band, side, bands, sig, shingles); of two sides only pairs across are compared.

    Texts nearest to all others come first, and texts whose classes have been joined are not compared any more. A pair
    that shares an earlier band is left to that band's bucket.
    """
    rid, comp, side = (table.column(c).to_numpy() for c in ("rid", "comp", "side"))
    band, n = table.column("band")[0].as_py(), table.num_rows
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)[:, :band]
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(n, SIZE)
    texts = [np.unique(np.frombuffer(x, np.uint32)) for x in table.column("shingles").to_pylist()]
    width = np.array([len(x) for x in texts])
    codes = np.unique(np.concatenate(texts), return_inverse=True)[1]
    texts = np.split(codes, np.cumsum(width)[:-1])
    across = side.min() != side.max()
    label = np.unique(comp, return_inverse=True)[1]
    score = np.zeros(n, np.int64)
    for register in sig.T:
        _, which, count = np.unique(register, return_inverse=True, return_counts=True)
        score += count[which]
    todo = np.ones(n, bool)
    mark = np.zeros(int(codes.max()) + 1, bool)
    a, b = [], []
    for i in np.argsort(-score, kind="stable"):
        todo[i] = False
        j = np.flatnonzero(todo & (label != label[i]) & ((side != side[i]) | (not across)))
        j = j[(sig[j] == sig[i]).mean(axis=1) >= similarity - 0.2]
        j = j[~(bands[j] == bands[i]).any(axis=1)]
        if len(j) == 0:
            continue
        mark[texts[i]] = True
        both = np.add.reduceat(mark[np.concatenate([texts[x] for x in j])].astype(np.int64), np.concatenate([[0], np.cumsum(width[j])[:-1]]))
        mark[texts[i]] = False
        for x in j[both / (width[i] + width[j] - both) >= similarity]:
            if label[x] != label[i]:
                a.append(min(rid[i], rid[x]))
                b.append(max(rid[i], rid[x]))
                label[label == label[x]] = label[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _lot(column: str, seed: int) -> Column:
    return F.xxhash64(column, F.lit(seed)).alias(f"lot_{column}")
