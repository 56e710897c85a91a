"""Operators of the training-data pipeline against brute force, on odd rows, and held out."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from hillwarden.llm import class_lm, decontaminate, exact_dedup, langid, licenses, near_dup, packing, pii, tables, toxicity
from hillwarden.llm import token_files as tf
from hillwarden.llm.queries import tokenizer_path
from hillwarden.llm.tokens import Encoder

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed=0):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(r.integers(50)) for i in r.integers(0, len(WORDS), n))


PASSAGE = prose(40, 99)
ROWS = [
    (1, "same text here", "a"), (2, "same  text\there", None), (2, "same  text\there", None), (None, "same text here", "a"),
    (3, None, None), (4, "", "b"), (5, "...", "b"), (6, prose(60, 6), "c"), (7, prose(60, 6) + " and a tail", "c"),
    (8, prose(20, 8) + " " + PASSAGE + " " + prose(20, 9), "c"), (9, prose(30_000, 10), "d"), (10, "Mail bob@example.com or +1 (743) 555-3824, card 4111 1111 1111 1111, host 10.0.0.1", None),
    (11, "Released under the MIT Licence", "x"), (12, "Copyright 2020 Bob\nReleased under the MIT License.\n\nother words", "x"),
]
SCHEMA = "doc_id long, text string, lang string, rk long, kept string, slot int, words string, n long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, s, 1, "k", 2, "w", 3) for d, t, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("q1", PASSAGE), ("q2", "same text"), ("q3", None), ("q4", "?!"), (None, "tail")], "item_id string, text string")


def test_exact_dedup(odd, none):
    out = exact_dedup.exact_dedup(odd).toPandas()
    assert len(out) == len(ROWS)
    group = out[out.text_sha256 == hashlib.sha256(b"same text here").hexdigest()]
    assert len(group) == 4 and set(group.keep_id) == {1} and set(group.group_size) == {4} and group.kept.sum() == 1
    empty = out[out.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert sorted(empty.doc_id) == [3, 4] and empty[empty.kept].doc_id.tolist() == [3]
    assert exact_dedup.exact_dedup(none).count() == 0
    sliced = exact_dedup.exact_dedup(odd, slices=3).toPandas()
    assert sorted(sliced.kept) == sorted(out.kept) and sorted(sliced.text_sha256) == sorted(out.text_sha256)
    left = exact_dedup.first_copies(odd, exact_dedup.exact_dedup(odd))
    assert left.columns == odd.columns and left.count() == out.text_sha256.nunique()


def brute_windows(text, items):
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    w, hit, who = cut(text), set(), set()
    for name, t in items:
        b = cut(t)
        n = min(10, len(b))
        known = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in known:
                hit.update(range(i, i + n))
                who |= {name} - {None}
    return len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_decontamination(odd, none, benchmark, most):
    items = [tuple(r) for r in benchmark.collect()]
    got = decontaminate.contamination(odd, benchmark, max_broadcast=most).collect()
    want = Counter((d, *brute_windows(t, items)) for d, t, _ in ROWS)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got) == want
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert decontaminate.contamination(odd, benchmark.limit(0)).where("contaminated").count() == 0


def test_licences(spark, odd, none):
    got = {r.doc_id: (r.whole_license, r.licenses, r.n_license_blocks) for r in licenses.scan(odd, licenses.registry(spark)).collect()}
    assert got[11] == ("MIT", "MIT", 1) and got[12][1:] == ("MIT", 2) and got[3] == (None, "", 0)
    assert licenses.scan(none, licenses.registry(spark)).count() == 0
    assert licenses.scan(odd, licenses.registry(spark, {}).limit(0)).where("n_license_blocks > 0").count() == 0


def test_licence_files_and_notices_inside_texts(spark):
    text = {k: v for k, v in licenses.NOTICES.items()}
    mit, apache, bsd = text["MIT"][2], text["Apache-2.0"][1], text["BSD-2-Clause"][0]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + mit, 1), (2, mit.replace("\n\n", "\n"), 2), (3, "Copyright 2020 X. Licensed under the MIT License.", 3),
        (4, "# Copyright 2021 J. Doe\n\n" + apache + "\n\nimport os", 4), (5, "Some words.\n\n" + bsd.upper() + "\n\nMore words.", 5),
        (6, mit.replace("free of charge", "for a fee"), 6), (7, "Copyright 2020 X", 7), (8, "(c) 2019 A. All rights reserved.\nReleased under the MIT Licence", 8),
        (9, "\n\n".join([mit] * 2), 9), (10, "The MIT License (MIT)\n\n© 2020 Y\n\n" + "\n\n\n".join(mit.split("\n\n")), 10),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, digest int"), licenses.registry(spark)).collect()}
    assert [got[k].whole_license for k in (1, 2, 3, 8, 10)] == ["MIT"] * 5
    assert (got[4].whole_license, got[4].licenses) == (None, "Apache-2.0") and (got[5].whole_license, got[5].licenses) == (None, "BSD-2-Clause")
    assert got[6].licenses == got[7].licenses == "" and (got[9].licenses, got[9].n_license_blocks) == ("MIT", 2)


def test_packed_bits():
    r = np.random.default_rng(1)
    for bits in (1, 5, 8, 16, 17, 32):
        ids = r.integers(0, 1 << bits, 500).astype(np.uint32)
        data = tf.pack(ids, bits)
        assert len(data) == -(-500 * bits // 8)
        assert (tf.unpack(data, bits, 0, 500) == ids).all() and (tf.unpack(data, bits, 123, 45) == ids[123:168]).all()
    block = tf.write_block(ids, np.array([0, 0, 200, 500]), 32)
    assert (tf.text_ids(block, 1) == ids[:200]).all() and len(tf.text_ids(block, 0)) == 0


def test_pieces_give_the_librarys_ids():
    tool = Encoder(tokenizer_path(), remember=20 * 205)
    texts = ["", " ", "  a  b ", "a\n b\n\n  c", "tail ", "\n", "it's  <|endoftext|> x  y", "a\nb c\nd\n", "ü 1234 !!! ", "'s 't \t a", "a \x1c b\x85c", prose(500)]
    for _ in range(2):
        ids, begin = tool.batch(texts)
        want = [e.ids for e in tool.lib.encode_batch_fast(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)] == want


def ids_of(rows):
    lib = Encoder(tokenizer_path()).lib
    return [(d, np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for d, t, *_ in rows]


def test_token_files(odd, none):
    got = tf.read_tokens(tf.write_tokens(odd, tokenizer_path())).orderBy("start").collect()
    want = Counter((d, len(i), zlib.crc32(i.tobytes())) for d, i in ids_of(ROWS))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert [r.doc_id for r in got][0] is None and [r.doc_id for r in got][1:] == sorted(d for d, *_ in ROWS if d)
    assert tf.read_tokens(tf.write_tokens(none, tokenizer_path())).count() == 0


def test_text_groups_hold_one_stretch():
    texts = ["", "é" * 3, "x" * 7, "", "yy", "z" * 20, "", "w"]
    batch = pa.record_batch({"doc_id": pa.array([None, *range(1, 8)], pa.int64()), "text": pa.array(texts)})
    got = list(tf.text_groups(batch.slice(1), 10))
    assert got == [([1, 2, 3], texts[1:4]), ([4], texts[4:5]), ([5], texts[5:6]), ([6, 7], texts[6:])]
    assert list(tf.text_groups(batch.slice(0, 1)))[0][0] == [None] and not list(tf.text_groups(batch.slice(0, 0)))
    large = pa.record_batch({"doc_id": pa.array(range(5_000)), "text": pa.array(["abc " * 1_000] * 5_000)})
    tracemalloc.start()
    n = sum(len("".join(t)) for _, t in tf.text_groups(large, 1 << 19))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000_000 and peak < 5_000_000


def test_packing(odd, none):
    got = packing.pack_documents(odd, tokenizer_path()).toPandas()
    ids = dict(ids_of([r for r in ROWS if r[0] == 9]))[9]
    long = got[got.doc_id == 9].sort_values("piece")
    assert (long.length[1:] == 2048).all() and long.length.sum() == len(ids) and long.start.tolist() == [0, *long.length.cumsum()[:-1]]
    assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(long.start, long.length, strict=True)] == long.ids_crc32.tolist()
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
    assert len(got[got.doc_id != 9].dropna()) + got.doc_id.isna().sum() == len(ROWS) - 1
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_packing_plan_is_near_the_bound():
    d = np.bincount(np.clip(np.random.default_rng(1).lognormal(6, 1, 20_000).astype(int), 1, 2047), minlength=2049)
    chosen = packing.plan(d)
    held = np.zeros_like(d)
    for ls, ks, times in chosen:
        held[ls] += ks * times
        assert (ls * ks).sum() <= 2048
    bound = -(-int((d * np.arange(2049)).sum()) // 2048)
    assert (held == d).all() and sum(t for *_, t in chosen) <= 1.005 * bound
    hard = np.zeros(2049, np.int64)
    hard[[1025, 683, 600, 400]] = 100, 200, 300, 77
    assert sum(t for *_, t in packing.plan(hard)) < sum(t for *_, t in packing.greedy(hard))


def shingle_set(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset([("bytes", text or "")])


def brute_classes(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    of = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = of[i], of[j]
                of = [min(a, b) if x in (a, b) else x for x in of]
    return of


def test_near_duplicates(spark, odd, none):
    got = near_dup.near_duplicates(odd).collect()
    want = defaultdict(list)
    for (d, *_), c in zip(ROWS, brute_classes(ROWS), strict=True):
        want[c].append(d)
    ids = sorted((min(x for x in v if x is not None), len(v)) for v in want.values())
    assert sorted({(r.class_id, r.class_size) for r in got}) == ids and sum(r.kept for r in got) == len(ids)
    assert near_dup.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_crowd(spark):
    base = prose(300, 5).split()
    rows = []
    for i in range(120):  # one large group of near copies, all texts different
        w = list(base)
        w[(i * 7) % 290] = f"edit{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:150]) + " " + prose(150, 1000 + i)) for i in range(60)]  # a shared passage only
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs, small=16).collect()}
    assert {got[i] for i in range(120)} == {0} and all(got[1000 + i] == 1000 + i for i in range(60))


def test_near_duplicates_joined_by_one_original_only(spark):
    base = prose(300, 6).split()
    rng = np.random.default_rng(6)
    rows = [(5000, " ".join(base))]
    for i in range(2000):  # each copy is near the original (0.84) and not near other copies (0.71)
        w = list(base)
        for place in rng.choice(58, 5, replace=False):
            w[5 * place + 4] = f"own{i}x{place}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = near_dup.near_duplicates(docs).groupBy("class_id").count().collect()
    assert [(r.class_id, r["count"]) for r in got] == [(0, 2001)]


def test_near_duplicates_with_repeated_passages_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        base = prose(60 + 3 * i, 400 + i).split()
        rows.append((3 * i, " ".join(base)))
        at = int(rng.integers(0, 40))
        rows.append((3 * i + 1, " ".join(base + base[at : at + 9] * int(rng.integers(1, 100)))))  # the same, nine words over and over
        edited = list(base)
        for place in rng.choice(len(base), int(rng.integers(1, 6)), replace=False):
            edited[place] = "edit"
        rows.append((3 * i + 2, " ".join(edited + base[:9] * 30)))
    sets = {d: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for d, t in rows for w in [t.split()]}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    root = {d: d for d in sets}
    for a, b in want:
        x, y = sorted((root[a], root[b]))
        root = {d: x if r == y else r for d, r in root.items()}
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 60
    found = sum(got[a] == got[b] for a, b in want)
    assert found >= 0.98 * len(want) and all(got[a] != got[b] or root[a] == root[b] for a in sets for b in sets)


def test_near_duplicates_in_blocks(spark):
    base = prose(300, 7).split()
    rows = []
    for i in range(240):  # 60 groups of 4 that share half of their words
        w = base[:150] + prose(150, 3000 + i // 4).split()
        w[40 + i % 4] = f"edit{i}"
        rows.append((i, " ".join(w)))
    sketched = near_dup.keep(near_dup.sketch(spark.createDataFrame(rows, "doc_id long, text string"), 5))
    now = sketched.select(near_dup.F.lit(1).alias("key"), near_dup.F.lit(0).alias("band"), "rid", near_dup.F.expr("if(doc_id < 120 and doc_id % 4 < 2, -9, rid)").alias("comp"))
    of = {r.rid: r.doc_id for r in sketched.collect()}
    for block in (16, 512):  # one class has blocks of its own; or all in one
        links = [(of[r.a], of[r.b]) for r in near_dup._crowded(now, sketched, 0.8, block=block).collect()]
        root = {i: -9 if i < 120 and i % 4 < 2 else i for i in range(240)}
        for a, b in links:
            assert a // 4 == b // 4
            root = {k: root[a] if v == root[b] else v for k, v in root.items()}
        assert len(set(root.values())) == 31


def test_pii(odd, none):
    got = {r.doc_id: r for r in pii.detect(odd).collect()}
    text = dict((d, t) for d, t, _ in ROWS)[10]
    want = [f"{k}:{text.index(x)}:{text.index(x) + len(x)}" for k, x in (("email", "bob@example.com"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (743) 555-3824"))]
    assert got[10].spans == ",".join(want) and got[10].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert got[3].spans == "" and got[3].n_email == 0 and len(got) == len({d for d, *_ in ROWS})
    assert pii.detect(none).count() == 0


def test_pii_of_very_long_runs(spark):
    rows = [(1, "7" * 100_000), (2, "7 " * 50_000), (3, "1." * 50_000), (4, "+1" * 50_000), (5, "+" + "1 " * 50_000), (6, "a@b" + ".c" * 50_000), (7, "x at " + "b dot " * 20_000)]
    rows.append((8, rows[1][1] + "a@b.c"))
    got = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].spans for k in (1, 2, 4, 5)] == [""] * 4 and got[3].n_ip == 50_000 // 4
    assert got[6].spans == f"email:0:{len(rows[5][1])}" and got[8].spans == "email:100000:100005"


def test_pii_learns_from_all_candidates(spark, monkeypatch):
    fitted = []

    class Watched(pii.Pipeline):
        def fit(self, rows):
            fitted.append((rows.count(), self.getStages()[-1].getMaxBins()))
            return super().fit(rows)

    monkeypatch.setattr(pii, "Pipeline", Watched)
    text = " and ".join([f"call 555-123-{k:04d} or +1 555 123 {k:04d} or write bob{k}@example.com" for k in range(30)])
    docs = spark.range(300).selectExpr("id AS doc_id", f"concat('{text} ', id) AS text")
    assert pii.detect(docs).count() == 300
    (n, bins), all_ = fitted[0], 300 * 90
    assert 0.68 * all_ < n < 0.72 * all_ and bins**2 >= n  # so many bins that no row is left out of the search for splits


def test_filters_keep_the_callers_columns(spark):
    rows = [(1, "a b", 7, "x", 8, 9), (2, "a b", 7, "x", 8, 9), (3, "c", 7, "x", 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rk int, bm_hit string, bm_slot int, bm_word int")
    left = exact_dedup.first_copies(docs, exact_dedup.exact_dedup(docs))
    assert left.columns == docs.columns and sorted(map(tuple, left.collect())) == [rows[0], rows[2]]
    keys = docs.where("doc_id = 3").select(tables.row_key().alias("rk"))
    left = tables.without(docs, keys)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect())) == rows[:2]


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95 and got.score.between(0, 1).all()
    out = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert out[3].lang_pred == out[4].lang_pred == out[5].lang_pred == "und" and out[3].score == 0
    assert langid.identify(none).count() == 0


def test_code_lengths_equal_the_trees():
    keys = [np.unique(np.array(k, np.uint64)) for k in ([97, 98], [0x6161, 0x6162], [], [], [])]
    trees = langid.Trees(["x"], [[(k, np.ones(len(k), np.int64)) for k in keys]])
    bits = lambda b: trees.lengths(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0, 0]
    # order 0: a, b once each (escape a half); after a: a, b once each
    assert bits(b"a") == pytest.approx(2) and bits(b"ab") == pytest.approx(4) and bits(b"z") == pytest.approx(1 + 8) and bits(b"az") == pytest.approx(2 + 1 + 1 + 8)


def test_toxicity(spark, odd, none):
    rows = [(i, prose(40, i) + (" vile nasty" if i % 5 == 0 else ""), 1 if i % 5 == 0 else 0) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, None), (None, 1), (99_999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all((got[d].predicted == y) for d, _, y in rows if got[d].held_out)
    assert toxicity.toxicity(odd, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(odd, labels).count() == len(ROWS) and toxicity.toxicity(none, labels).count() == 0


def test_toxicity_counts_texts_that_share_a_passage_and_takes_the_majority_label(spark):
    shared = prose(5, 1)
    rows = [(shared + " " + prose(60, 50 + i), i % 2) for i in range(20)]  # a passage in common only
    base = prose(80, 90)
    rows += [(base + tail, y) for tail, y in (("", 1), (" a", 0), (" b", 0), (" b", 0), (" c", 1))]  # one class, mostly 0
    other = prose(80, 91)
    rows += [(other, 1), (other + " a", 0)]  # a tie counts as 1
    got = toxicity.distinct(spark.createDataFrame(rows, "text string, toxic int")).collect()
    assert len(got) == 22 and sum(r.toxic for r in got if r.text.startswith(shared)) == 10
    assert [r.toxic for r in got if r.text.startswith(base)] == [0] and [r.toxic for r in got if r.text.startswith(other)] == [1]


def test_class_model(spark, odd, none):
    got = class_lm.class_scores(odd, clustered=50, classes=8, most=200, rounds=2).collect()
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]
    out = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t, _ in ROWS if not out(d) for w in cut(t))
    total = sum(c.values()) + len(c) + 1
    want = sorted((len(cut(t)), sum(c[w] > 0 for w in cut(t)), round(sum(np.log10((c[w] + 1) / total) for w in cut(t)), 4)) for _, t, _ in ROWS)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and r.train_tokens == sum(c.values()) for r in got)
    assert class_lm.class_scores(none).count() == 0


def test_words_go_where_the_class_bigrams_are_likeliest():
    rng = np.random.default_rng(3)
    words, classes, total = 40, 5, 5 + class_lm.SHAPES
    pairs = rng.poisson(0.7, (words, words)) * (1 - np.eye(words, dtype=int))
    of = rng.integers(0, classes, words)
    of[:6] = classes + rng.integers(0, class_lm.SHAPES, 6)  # no class yet
    table = lambda own: np.bincount((own[:, None] * total + own[None, :]).ravel(), pairs.ravel(), total * total).reshape(total, total).astype(float)
    flow = lambda x: np.sum(x[x > 0] * np.log(x[x > 0]))
    likely = lambda t: flow(t) - flow(t.sum(0)) - flow(t.sum(1))
    side = lambda p: class_lm._sparse(np.repeat(np.arange(words), words), np.tile(of, words), p.ravel().astype(float), total)
    drop = lambda x: tuple(c[x[2] > 0] for c in x)
    got = class_lm.best_classes(table(of), of, drop(side(pairs)), drop(side(pairs.T)), classes, block=7)
    for w in range(words):
        tried = [likely(table(np.where(np.arange(words) == w, c, of))) for c in range(classes)]
        best = int(np.argmax(tried))
        stay = of[w] < classes and tried[of[w]] >= tried[best] - 1e-6
        assert got[w] == (of[w] if stay else best)


def test_every_word_is_in_a_class_by_its_neighbours(spark):
    rng = np.random.default_rng(5)
    # words of two kinds take turns; all have one shape, and most are too rare for the lexicon
    word = lambda kind: f"{kind}{int(600 * rng.random() ** 4):03d}e"
    texts = [" ".join(word("pq"[k % 2]) for k in range(40)) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "doc_id % 5 = 0 AS held_out")
    train = [t.split() for i, t in enumerate(texts) if i % 5]
    model, rare = class_lm.learn(docs.where("not held_out"), clustered=30, classes=4, most=80, rounds=4)
    c = Counter(w for t in train for w in t)
    data = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
    key = {w: int(class_lm.token_keys(*data(w))[0][0]) for w in {w for t in texts for w in t.split()}}
    outside = {r.key % 2**64: r for r in rare.collect()}
    inside = dict(zip(model.lexicon.keys.tolist(), zip(model.lexicon.counts.tolist(), model.of[model.lexicon.symbols].tolist())))
    place = {w: inside.get(key[w]) or (outside[key[w]].c, outside[key[w]].k) for w in c}
    assert len(inside) <= 81 and len(outside) > 150 and len(inside) + len(outside) == len(c) + 1
    assert all(n == c[w] and k < 4 for w, (n, k) in place.items())
    often = [w for w in c if key[w] in outside and c[w] > 2]
    kinds = {k: Counter(w[0] for w in often if place[w][1] == k) for k in range(4)}
    assert sum(max(x.values(), default=0) for x in kinds.values()) > 0.95 * len(often)  # classes tell the kinds apart
    assert model.mass[:4].sum() == sum(c.values()) + len(train)  # all tokens and ends

    # every score, token by token
    end = inside[int(class_lm.END)]
    got = {r.doc_id: r for r in class_lm.score(docs, model, rare).collect()}
    for i, t in enumerate(texts):
        k = [end[1]] + [place[w][1] if w in place else 4 + (key[w] >> 58) for w in t.split()] + [end[1]]
        n = [place[w][0] if w in place else 0 for w in t.split()] + [end[0]]
        want = sum(model.step[a, b] + float(model.emission(np.array(x), np.array(b), 0.5)) for a, b, x in zip(k, k[1:], n))
        assert got[i].score == pytest.approx(want) and got[i].n_known == sum(x > 0 for x in n) and got[i].n_tokens == len(n)
        assert got[i].base_score == pytest.approx(sum(np.log10(x + 1) for x in n) - len(n) * np.log10(model.tokens + model.words + 1))
