"""Quality by compression, whitening by spectrum slicing, periodic runs: brute force, held-out labels, odd rows."""

import hashlib
import zlib

import numpy as np
import pytest

from hillwarden.llm import periodic, quality, whitening
from hillwarden.llm.queries import QUERIES


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and j > i and not any(all(w[i + t] == w[i + t + r] for t in range(n - r)) for r in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng, seen = np.random.default_rng(3), 0
    for _ in range(600):
        w = [b"w%d" % x for x in rng.integers(0, rng.integers(1, 5), rng.integers(0, 70))]
        if rng.random() < 0.6:
            w = w[: rng.integers(0, len(w) + 1)] + w[: rng.integers(1, 9)] * int(rng.integers(1, 9)) + w[:5]
        want = brute_runs(w)
        seen += len(want)
        assert [tuple(r) for r in periodic.document_runs(w).tolist()] == want
        # without the stretches, the trees of the whole document give the same
        ids = (np.unique(w, return_inverse=True)[1] + 1).tolist() if w else []
        assert [tuple(r) for r in periodic.runs(ids).tolist()] == want
    assert seen > 300


def test_suffix_tree_common_prefixes():
    rng = np.random.default_rng(5)
    ids = rng.integers(1, 3, 300)
    tree = periodic.SuffixTree(ids.tolist())
    i, j = rng.integers(0, 300, 500), rng.integers(0, 300, 500)
    i, j = i[i != j], j[i != j]
    brute = [next((k for k in range(300) if a + k >= 300 or b + k >= 300 or ids[a + k] != ids[b + k]), 300) for a, b in zip(i, j, strict=True)]
    assert tree.common(i, j).tolist() == brute
    order = sorted(range(301), key=lambda k: ids[k:].tolist())
    assert np.argsort(tree.ranks(False)).tolist() == order
    assert np.argsort(tree.ranks(True)).tolist() == sorted(range(301), key=lambda k: (3 - ids[k:]).tolist())


def runs_of(text, key, plant):
    w = (text or "").encode().split()
    code = zlib.crc32(str(key).encode()) if key is not None else 1
    n = len(w)
    if plant and code % 10 == 0 and n:
        g = code // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t).hexdigest()
    return (key, len(found), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_documents(spark):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 40, n))
    rows = [(k, text(rng.integers(0, 60)), 1) for k in range(150)] + [(7, None, 2), (None, "a a a a a a a", 3), (9, "", 4), (9, "", 4), (11, " x y\tx y\n" * 9, 5), (12, "a b " * 20_000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, period int")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = docs.where("doc_id is null or doc_id <> 12")
    got = [tuple(r) for r in periodic.periodic_runs(small, plant=True).select(columns).collect()]
    want = [runs_of(t, k, True) for k, t, _ in rows if k != 12]
    assert sorted(got, key=str) == sorted(want, key=str)
    long = periodic.periodic_runs(docs.where("doc_id = 12 and period = 6")).first()
    assert (long.n_runs, long.start, long.length, long.period, long.collapsed) == (1, 0, 40_000, 2, "a b")
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def symmetric(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


def test_inertia_counts_and_eigenpairs():
    rng = np.random.default_rng(4)
    for _ in range(100):
        a = rng.integers(-3, 4, (6, 6)).astype(float)
        assert whitening.count_above(a + a.T, 0.3) == (np.linalg.eigvalsh(a + a.T) > 0.3).sum()
    for values in ([9.0, 9.0, 9.0, 1.0, 0.0], [5.0, 4.999999, 4.99999, 4.0, 1e-8], list(range(40)), [1e-30, 1.0, 1e20]):
        v = symmetric(np.array(values), 2)
        e, x = whitening.leading(v, 4)
        want = np.sort(values)[::-1][:4]
        assert np.allclose(e, want, atol=1e-13 * max(values)) and np.allclose(x @ x.T, np.eye(len(e)), atol=1e-12)
        assert np.linalg.norm(v @ x.T - x.T * e) < 1e-11 * max(values)
    assert whitening.leading(np.zeros((3, 3)), 4)[0].tolist() == [0, 0, 0]


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 6)) * [3, 2, 1.5, 1, 0.7, 0.2] + 5
    x[10:60] = x[10]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    rows += [(900, None, 0), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (902, [float("nan")] * 6, 0), (903, [1.0, float("inf"), 1.0, 1.0, 1.0, 1.0], 0), (904, [1.0], 0), (905, [], 0), (None, x[0].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got = whitening.whiten(table).toPandas()
    steps = np.floor(256 * x).astype(int)
    fit = np.unique(steps, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh(np.cov(fit.T, bias=True))
    assert len(got) == 4 * 301 and set(got.n) == {n} and (got.identity_error <= 1e-9).all()
    assert got[got.vec_id.isna()].component.tolist() == [1, 2, 3, 4]
    own = got[got.vec_id.notna()].sort_values(["vec_id", "component"])
    assert own[own.component == 1].deviation.tolist() == ((n * steps - s) ** 2).sum(axis=1).tolist()
    for k in range(4):
        mine = own[own.component == k + 1]
        want = (steps - s / n) @ q[:, -1 - k] / np.sqrt(e[-1 - k])
        assert min(np.abs(mine.whitened - want).max(), np.abs(mine.whitened + want).max()) < 1e-9
        assert np.allclose(mine.explained, e[-1 - k] / e.sum(), rtol=1e-9)


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, x int, component int"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    alike = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, 1), (1, [1.0, 2.0], 1, 1)], schema)).collect()
    assert len(alike) == 4 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 for r in alike)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0], 1, 1), (2, [-1e30, 1.0], 1, 1)], schema)).collect()
    assert len(huge) == 4 and all(r.deviation is None for r in huge)


def test_quality_finds_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality"](spark, d).toPandas().merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert ((held.predicted == held.quality).mean()) > 0.95
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97
    for low, high in ((0.0, 0.2), (0.8, 1.01)):  # what is called likely is likely
        part = got[(got.score >= low) & (got.score < high)]
        assert abs(part.quality.mean() - part.score.mean()) < 0.1


def test_quality_measures_are_plain_sizes():
    import zstandard

    rng = np.random.default_rng(2)
    pieces = {c: [bytes(rng.choice(list(a), 800).tolist()) for _ in range(60)] for c, a in (("good", b"abc "), ("bad", b"#$% "))}
    m = quality.Model(quality.dictionary(pieces["good"]), quality.dictionary(pieces["bad"]))
    raw = pieces["good"][0] * 5
    size = {}
    for c, d in (("good", m.good), ("bad", m.bad)):
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
        size[c] = sum(len(packer.compress(raw[i : i + 2048])) for i in range(0, len(raw), 2048))
    assert m.measures(raw) == ((size["bad"] - size["good"]) / (size["bad"] + size["good"]), np.log((size["good"] + 1) / (len(raw) + 1)))
    assert m.measures(pieces["good"][1])[0] > 0 > m.measures(pieces["bad"][1])[0]


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(k, t, 1, 0.5) for k, t in [(1, None), (2, ""), (None, "x"), (3, "same"), (3, "same"), (4, "long " * 200_000)]], "doc_id long, text string, label int, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality(docs, none).collect()] == [0.5] * 6
    one = spark.createDataFrame([(k, 1, 0) for k in (1, 2, 3, 4, 5)] + [(3, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.quality(docs, one).collect()} == {1}
    both = spark.createDataFrame([(k, k % 2, 0) for k in range(6)], "doc_id long, quality int, toxic int")
    out = quality.quality(docs, both).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out) and out[3] == out[4]
    assert quality.quality(docs.limit(0), both).count() == 0


@pytest.mark.parametrize("name", ["op11_quality", "op12_whitening", "op13_periodic_runs"])
def test_queries_cover_their_tables(spark, name):
    d = "/root/testdata/sf0.001"
    rows = QUERIES[name](spark, d).count()
    assert rows == (4 * spark.read.parquet(f"{d}/embeddings.parquet").count() if "whitening" in name else spark.read.parquet(f"{d}/documents.parquet").count())
