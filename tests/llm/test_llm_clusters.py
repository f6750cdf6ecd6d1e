"""SimHash links, importance resampling and centroid clustering against brute
force, and the defined result of awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import orchard, resample, simhash

W = r"[^\x20\x09-\x0D]+"
COLUMNS = ("doc_id long, text string, source string, fp long, least long, shard string, component double, "
           "rank string, score int, weight string, line int, times int, e string, v int, n long, bucket int")
REST = (None, 1, None, "s", 0.5, "r", None, "w", 7, 8, "e", 9, None, 3)


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and long texts, repeated rows, equal ids, clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    texts = [None, "", " \n\t ", "one", "One", "a b c d", "A B c D", long, long + "\nend", "x " * 100,
             "\n\nsix words on\n\n \nmany\tlines here\n", "six words on\n\n \nmany lines here\n"]
    rows = [(i, t, *REST) for i, t in enumerate(texts)]
    rows += [rows[10], (None, texts[10], *REST), (None, None, *REST), (3, "another text with a taken id", *REST)]
    return spark.createDataFrame(rows, COLUMNS)


# ---------------------------------------------------------------- SimHash

def brute_fingerprint(text, n=3, seed=42):
    w = re.findall(W, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(prints, distance):
    """prints: [(doc_id, fingerprint)] -> the smallest reachable doc_id of each row."""
    own = list(range(len(prints)))

    def root(i):
        while own[i] != i:
            own[i] = own[own[i]]
            i = own[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance:
                own[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(prints))]


def texts_with_copies(seed=3, n=300):
    rng = np.random.default_rng(seed)
    words = [f"w{i}é" for i in range(40)] + ["A", "b"]
    base = [list(rng.choice(words, rng.integers(30, 200))) for _ in range(6)]
    rows = []
    for i in range(n):
        t = list(base[rng.integers(6)]) if i % 3 else list(rng.choice(words, rng.integers(0, 60)))
        for _ in range(rng.integers(0, 4)):
            if t:
                t[rng.integers(len(t))] = str(rng.choice(words))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(t)))
    return rows


@pytest.mark.parametrize("chunk, blocks", [(8192, None), (20, None), (7, 5), (50, 7)])
def test_simhash_equals_brute_force(spark, chunk, blocks):
    """Also with hot shards dealt to chunks, and with other block tables."""
    rows = texts_with_copies()
    got = simhash.near_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"),
                                    chunk=chunk, blocks=blocks).orderBy("doc_id").collect()
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    assert [r.fingerprint for r in got] == [f"{p:016x}" for _, p in prints]
    assert [r.component_id for r in got] == brute_classes(prints, 3)
    assert len({r.component_id for r in got}) < len(set(p for _, p in prints))  # different prints do link


def test_spark_hashes_shingles_alike(spark):
    text = "the quick Brown fox jumps"
    got = [r[0] % 2**64 for r in spark.createDataFrame([("the quick brown",), ("quick brown fox",), ("brown fox jumps",)],
                                                       "t string").select(F.xxhash64("t")).collect()]
    assert simhash.shingle_hashes(text.encode(), 3, 42).tolist() == got


def test_fingerprint_of_many_hashes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 254, 255, 256, 5000):
        h = rng.integers(0, 2**64, n, np.uint64)
        h[: n // 2] |= np.uint64(1 << 63)
        want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > n)
        assert simhash.fingerprint(h) == want


def test_bk_tree_finds_all_and_looks_at_few():
    rng = np.random.default_rng(2)
    fp = np.unique(rng.integers(0, 2**64, 3000, np.uint64))
    near = fp[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    ask = np.concatenate([fp, near])
    shard = rng.integers(0, 3, len(fp))
    of = np.concatenate([shard, shard[:500]])
    forest = simhash.Forest(shard, fp)
    for distance in (0, 1, 3):
        u, v, looked = forest.search(of, ask, distance)
        want = {(i, j) for i in range(len(ask)) for j in
                np.flatnonzero((np.bitwise_count(ask[i] ^ fp) <= distance) & (shard == of[i])).tolist()}
        assert set(zip(u.tolist(), v.tolist())) == want
        assert looked < len(ask) * len(fp) / 3 * (0.02 if distance == 0 else 0.7)
    # every node hangs on the edge of its distance to its parent, and no parent has two of one length
    parent, edge = np.divmod(forest.edges, 65)
    assert (np.bitwise_count(fp[parent] ^ fp[forest.children]) == edge).all()
    assert len(np.unique(forest.edges)) == len(forest.edges) == len(fp) - 3
    assert [len(x) for x in simhash.Forest(shard[:0], fp[:0]).search(of, ask, 3)[:2]] == [0, 0]


def test_tables_miss_no_link():
    rng = np.random.default_rng(4)
    for distance in (1, 3):
        for blocks in range(distance + 1, 2 * distance + 2):
            tables = simhash.masks(blocks, distance)
            assert len(tables) == math.comb(blocks, distance)
            for _ in range(200):
                flip = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
                assert any(flip & m == 0 for m in tables)
    assert [simhash.blocks_for(n, 3) for n in (0, 10**6, 10**9, 10**12, 10**14)] == [4, 4, 5, 6, 7]


def test_simhash_awkward(awkward):
    got = simhash.near_fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {0, 1, 2, None} and {r.component_id for r in zero} == {0}
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    assert by[5].fingerprint == by[6].fingerprint and by[6].component_id == 5
    assert by[4].component_id == 3  # "One" and "one"; the other text with id 3 may be elsewhere
    same = [r for r in got if r.fingerprint == by[10].fingerprint]
    assert len(same) == 4 and {r.component_id for r in same} == {10}
    assert simhash.near_fingerprints(awkward.limit(0)).count() == 0
    alone = simhash.near_fingerprints(awkward.where("doc_id IS NULL")).collect()
    assert {r.component_id for r in alone} == {None}


# ---------------------------------------------------------------- resampling

RW = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_features(text):
    w = re.findall(RW, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute_resample(rows, target, percent=25, least=20):
    s, t = (Counter(b for x in texts for b in brute_features(x)) for texts in ([x for _, x in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, x in rows:
        f = brute_features(x)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in f)
        weight = gain // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r in out if r[1] >= 2 * least - 1]
    for k, r in enumerate(sorted(able, key=lambda r: (-r[3], r[0]))[:len(able) * percent // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_resample_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    words = ["The", "cat", "naïve", "ÄRGER", "x1", "it's", "a-b", "42", "中文", "{", "~", "É"]
    lines = [" ".join(rng.choice(words, rng.integers(0, 9))) for _ in range(40)]
    rows = [(i, rng.choice(["\n", "\r\n", "\n\n"]).join(rng.choice(lines, rng.integers(0, 14)))) for i in range(150)]
    target = ["The cat\nx1 naïve", "", "42 42 42", None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resample.resample(docs, spark.createDataFrame([(1, t) for t in target], "item_id int, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(rows, target)
    assert got.where("rank IS NOT NULL").count() > 5


def test_line_parts_make_up_the_text():
    """The features of the lines and the pairs across breaks are those of the text."""
    for text in ("a b\nc\n\n \nd e f", "\n", "", "one", "x\ny\nz", "a\x00b\nC\x7fd " + "w" * 500):
        lines = text.encode().split(b"\n")
        inside, _ = resample.line_features([resample.line_words(x) for x in lines], 10_000)
        across = [zlib.crc32(p) % 10_000 for p in resample.break_pairs(lines)]
        assert sorted([*inside.tolist(), *across]) == sorted(brute_features(text))


def test_resample_awkward(spark, awkward):
    target = spark.createDataFrame([("six words", 3)], "text string, times int")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = resample.resample(awkward, target, percent=100, least_words=4)
    want = brute_resample([r for r in rows if r[0] is not None], ["six words"], 100, 4)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {tuple(r)[:2] for r in got.collect() if r.doc_id is not None} == {r[:2] for r in want}
    ranks = sorted(r.rank for r in got.collect() if r["rank"] is not None)
    assert ranks == list(range(1, 1 + sum(len(brute_features(t)) >= 7 for _, t in rows)))
    assert all((r.n_features, r.weight) == (0, 0) for r in got.collect() if r.doc_id in (0, 1, 2))
    assert resample.resample(awkward.limit(0), target).count() == 0
    assert resample.resample(awkward, target.limit(0)).count() == awkward.count()


# ---------------------------------------------------------------- clustering

def brute_clusters(rows, k=16, rounds=3, dim=64):
    v = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows
         if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    c = [x for _, x in sorted(v, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))][:k]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c)) for _, x in v]

    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            some = [x for (_, x), (_, at) in zip(v, own) if at == j]
            if some:
                c[j] = [sum(col) // len(some) for col in zip(*some)]
    own = assign()
    per = Counter()
    for d, j in own:
        per[j] += d
    return sorted([(i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(v, own)], key=repr)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=64) * rng.integers(1, 4)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(i + 300, [float(rng.integers(-1, 2))] * 64) for i in range(60)]  # ties, equal centroids
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [math.nan] + [0.0] * 63), (904, [math.inf] + [0.0] * 63),
             (905, [None] + [0.0] * 63), (906, [0.0] * 64), (907, [-0.001] * 64), (None, [0.5] * 64), (906, [0.0] * 64),
             (907, [1.0] * 65)]
    table = spark.createDataFrame([(*r, "c", 1, "d", 2.0) for r in rows],
                                  "vec_id long, embedding array<float>, cluster string, n int, e string, distance double")
    got = orchard.cluster(table.repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows)
    few = orchard.cluster(table.where("vec_id < 3"))
    assert sorted(map(tuple, few.collect()), key=repr) == brute_clusters(rows[:3])
    assert orchard.cluster(table.where("vec_id = 900")).count() == 0
    assert orchard.cluster(table.limit(0)).columns == got.columns


def test_orchard_is_exact_and_skips():
    rng = np.random.default_rng(10)
    for k, dim in ((1, 3), (16, 8), (60, 2), (40, 64)):
        c = rng.integers(-9, 9, (k, dim)) * rng.integers(1, 30)
        c[k // 2] = c[0]  # equal centroids: the smaller number wins
        x = np.concatenate([c[rng.integers(0, k, 400)] + rng.integers(-3, 4, (400, dim)), (c[:-1] + c[1:]) // 2])
        all_d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        own, d, computed = orchard.Orchard(c).nearest(x)
        assert (own == all_d.argmin(1)).all() and (d == all_d.min(1)).all()
        assert computed <= len(x) * k
    assert computed < len(x) * k * 0.9


def test_a_component_that_does_not_fit_raises(spark):
    table = spark.createDataFrame([(1, [1e30] + [0.0] * 63)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 1048576"):
        orchard.cluster(table).collect()


def test_results_do_not_depend_on_partitions(spark):
    rows = texts_with_copies(seed=12, n=60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("w1é w2é",)], "text string")
    for f in (lambda x: simhash.near_fingerprints(x), lambda x: resample.resample(x, target)):
        one, many = (pd.DataFrame(f(docs.repartition(n)).orderBy("doc_id").collect()) for n in (1, 7))
        assert one.equals(many)
