"""Manifest, whitening and SimHash against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import differences, expected, oracle
from tests.llm.test_text_operators import odd_docs, texts
from tidewheel.llm import merkle, queries, simhash, whitening

FOLDER = "/root/testdata/sf0.001"


# Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, fanout):
    """Root and, per leaf, the siblings from below (left, right)."""
    paths = [[] for _ in leaves]
    level, at = list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            start = p - p % fanout
            paths[i].append(("".join(level[start:p]), "".join(level[p + 1 : start + fanout])))
        level = [h(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
        at = [p // fanout for p in at]
    return level[0], paths


def brute_manifest(rows, fanout):
    """``(group, order, leaf)`` rows to ``(order, leaf, subroot, root, path)`` counts."""
    groups = defaultdict(list)
    for g, o, leaf in rows:
        groups[g].append((o is not None, o or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf for *_, leaf in sorted(groups[g])], fanout) for g in names}
    root, tops = brute_tree([trees[g][0] for g in names], fanout)
    out = Counter()
    for g, top in zip(names, tops):
        for (known, o, leaf), path in zip(sorted(groups[g]), trees[g][1]):
            out[(o if known else None, leaf, trees[g][0], root, tuple(path + top))] += 1
    return out


@pytest.mark.parametrize("fanout,height", [(2, 6), (2, 2), (3, 1), (3, 3), (5, 2)])
def test_manifest(spark, fanout, height):
    sizes = {None: 9, "": 1, "a": 2, "b": 33, "é": 5, "z": 70, "ä": 27}
    rows = [(g, (7 * i) % 101 if i else None, h(str(g), str(i))) for g, n in sizes.items() for i in range(n)]
    rows += [rows[3]] * 6 + [("b", None, h("x"))]  # repeated rows, a second null
    df = spark.createDataFrame(rows, "group string, position long, leaf string").withColumn("tree", F.lit(1)).withColumn("row", F.lit(2))
    got = Counter()
    listed = merkle.manifest(df, "group", "position", fanout=fanout, height=height)
    for r in listed.withColumn("folded", merkle.fold(F.col("row.leaf"), F.col("path"))).collect():
        path = tuple((s.left, s.right) for s in r.path)
        assert r.folded == r.root and (r.row.tree, r.row.row) == (1, 2)
        got[(r.row.position, r.row.leaf, r.subroot, r.root, path)] += 1
    assert got == brute_manifest(rows, fanout)


def test_manifest_of_little(spark):
    df = spark.createDataFrame([("a", 1, h("x"))], "group string, place long, leaf string")
    one = merkle.manifest(df, "group", "place").collect()[0]
    assert (one.subroot, one.root, one.path) == (h("x"), h("x"), [])
    assert merkle.manifest(df.limit(0), "group", "place").count() == 0


def test_leaf_marks_null_and_length(spark):
    df = spark.createDataFrame([(1, None, "é|"), (None, 5, "")], "a long, b int, c string")
    got = df.select(merkle.leaf(F.col("a"), F.col("b"), F.col("c")).alias("l")).collect()
    assert [r.l for r in got] == [h("1:1", "-", "3:é|"), h("-", "1:5", "0:")]


@pytest.mark.parametrize("change", [lambda d: d, lambda d: d.withColumn("lang", F.lit(None).cast("string")), lambda d: d.where("doc_id < 3")])
def test_manifest_query(spark, tmp_path, change):
    for t in ("documents",):
        change(spark.read.parquet(f"{FOLDER}/{t}.parquet")).toPandas().to_parquet(f"{tmp_path}/{t}.parquet", index=False)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id, text, lang::VARCHAR AS lang, source, n_chars FROM read_parquet('{tmp_path}/documents.parquet')")
    spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("lang", F.col("lang").cast("string")).write.parquet(f"{tmp_path}/in/documents.parquet")
    df = queries.QUERIES["op11_merkle_manifest"](spark, f"{tmp_path}/in")
    rows = [tuple(r) for r in df.collect()]
    names, _, wanted = expected(con, queries.ORACLES["op11_merkle_manifest"])
    assert differences(df.columns, rows, names, wanted) is None
    tampered = {d for d, *_ in rows if zlib.crc32(str(d).encode()) % 7 == 0}
    assert {r[0] for r in rows if not r[-1]} == tampered


def test_manifest_query_of_odd_rows(spark, tmp_path):
    odd_docs(spark).select("doc_id", "text", F.lit("x").alias("lang"), "source", F.lit(None).cast("long").alias("n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    assert len(got) == odd_docs(spark).count() and all(r.verified for r in got)


# whitening


def brute_whitening(x):
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    v = (fit - mean).T @ (fit - mean) / len(fit)
    e, u = np.linalg.eigh(v)
    return fit, mean, e[::-1], u[:, ::-1], np.trace(v)


def check_whitening(x, ids, rows, tolerance=1e-7):
    fit, mean, e, u, trace = brute_whitening(x)
    assert Counter((r.vec_id, r.component) for r in rows) == Counter((i, c) for i in ids for c in range(1, 5))
    where = defaultdict(list)
    for n, i in enumerate(ids):
        where[i].append(n)
    sums = fit.astype(object).sum(axis=0)
    exact = [sum(int(v) ** 2 for v in len(fit) * row.astype(object) - sums) for row in x]
    scores = (x - mean) @ u[:, :4] / np.sqrt(e[:4])
    sign = {}
    for r in rows:
        assert r.n == len(fit) and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-10)
        assert r.deviation in {exact[n] for n in where[r.vec_id]}
        wanted = [scores[n, r.component - 1] for n in where[r.vec_id]]
        if len(wanted) == 1 and abs(wanted[0]) > 0.1:
            assert sign.setdefault(r.component, np.sign(wanted[0] * r.whitened)) == np.sign(wanted[0] * r.whitened)
        assert any(abs(r.whitened) == pytest.approx(abs(w), abs=tolerance) for w in wanted)


def test_whitening_query(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{FOLDER}/embeddings.parquet'").fetchall()
    x = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    check_whitening(x, [i for i, _ in rows], queries.QUERIES["op12_embedding_whitening"](spark, FOLDER).collect())


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    c = rng.standard_normal((300, 7)) @ rng.standard_normal((7, 7)) + 5
    c[100:180] = c[0]  # copies count once
    c[200] *= 1e3  # long grid numbers
    rows = [(n, v.tolist()) for n, v in enumerate(c)] + [(None, c[5].tolist()), (7, c[8].tolist())]
    bad = [(900, None), (901, [None] + [1.0] * 6), (902, [float("nan")] * 7), (903, [float("inf")] + [0.0] * 6), (904, []), (905, [1.0] * 6)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("n", F.lit(1)).withColumn("v", F.lit(1)).withColumn("x", F.lit(1))
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    check_whitening(x, [i for i, _ in rows], whitening.whiten(df, whitening.fit(df)).collect(), 1e-5)


def test_whitening_without_variance(spark):
    kind = "vec_id long, embedding array<float>"
    whole = lambda rows: whitening.whiten(d := spark.createDataFrame(rows, kind), whitening.fit(d)).collect()
    assert whole([]) == [] and whole([(1, None), (2, [])]) == [] and whole([(1, [1.0, 2.0])] * 3) == []
    got = whole([(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (3, [1e30, float("nan"), 0.0])])
    assert [(r.vec_id, r.component, r.deviation) for r in sorted(got)] == [(1, 1, 512**2), (2, 1, 512**2)]
    assert all(abs(r.whitened) == pytest.approx(1) and r.explained == pytest.approx(1) for r in got)


def test_deviation_beyond_a_long():
    x = np.array([[1, 0], [1 << 33, 0]])
    got = whitening._deviation(x, 10, [5, 0]).to_pylist()
    assert got == [25, None]


@pytest.mark.parametrize("d,rank", [(1, 1), (5, 5), (33, 20), (64, 64)])
def test_factor_and_rotations(d, rank):
    rng = np.random.default_rng(d)
    b = rng.standard_normal((d, rank)) * np.logspace(0, -4, rank)
    g = whitening.pivoted_cholesky(b @ b.T)
    assert g.shape == (d, rank) and np.allclose(g @ g.T, b @ b.T, atol=1e-14)
    # a row per pivot, each with one entry less above the diagonal
    assert sorted((np.abs(g) > 1e-12).sum(axis=1))[:rank] == list(range(1, rank + 1)) or rank < d
    squares, axes = whitening.jacobi(g)
    assert np.allclose(squares, np.linalg.svd(b, compute_uv=False) ** 2, rtol=1e-8)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-13) and np.allclose(axes * squares @ axes.T, b @ b.T, atol=1e-14)


# SimHash


def brute_print(text):
    words = bytes((text or "").encode()).lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def brute_copies(rows, radius=4):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def near_texts():
    words = [f"w{n}" for n in range(400)]
    rng = np.random.default_rng(2)
    rows = []
    for base in range(12):
        own = list(rng.choice(words, 300))
        for copy in range(15):
            changed = list(own)
            for at in rng.integers(0, 300, copy // 3):
                changed[at] = "new"
            rows.append((1000 - len(rows), " ".join(changed)))
    rows += [(2000 + n, t) for n, t in enumerate(["", None, " \t", "a", "A", "a b", "a b c d", "A\nb  c D", "é ß", "x " * 40_000])]
    return rows + [(None, rows[0][1]), (None, "only here"), rows[4], rows[4]]


@pytest.mark.parametrize("block,width", [(None, 1 << 18), (7, 5)])
def test_simhash(spark, monkeypatch, block, width):
    monkeypatch.setattr(simhash, "STEP", width)
    rows = near_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit(1)).withColumn("rep", F.lit(1))
    got = Counter(tuple(r) for r in simhash.near_copies(df, block=block).collect())
    assert got == brute_copies(rows)


def test_simhash_query(spark):
    got = Counter(tuple(r) for r in queries.QUERIES["op13_simhash"](spark, FOLDER).collect())
    assert got == brute_copies(texts())


def test_simhash_of_little(spark):
    assert simhash.near_copies(odd_docs(spark).limit(0)).count() == 0
    one = simhash.near_copies(spark.createDataFrame([(3, None)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == [(3, "0" * 16, 3)]


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{n % 97} and{n % 31}" for n in range(4000)).encode()
    wanted = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert simhash.fingerprint(text) == wanted == brute_print(text.decode())


def test_tiles_keep_all_links():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) for n in rng.integers(1, 6, 900)]
    prints = np.unique(np.append(base, rng.choice(base, 900) ^ np.array(flips, np.uint64)))
    left, right = prints[::2], prints[1::2]
    nodes = {int(p): n for n, p in enumerate(prints)}

    def groups(pairs):
        label = list(range(len(prints)))
        for a, b in pairs:
            p, q = label[a], label[b]
            label = [q if c == p else c for c in label]
        return Counter(map(frozenset, [[i for i, c in enumerate(label) if c == x] for x in set(label)]))

    found = simhash.joining_links(left, right).tolist()
    every = [(nodes[int(a)], nodes[int(b)]) for a in left for b in right if (int(a) ^ int(b)).bit_count() <= 4]
    assert len(found) < len(every) and all((a ^ b).bit_count() <= 4 for a, b in found)
    assert groups((nodes[a], nodes[b]) for a, b in found) == groups(every)


def test_layout_of_blocks():
    rng = np.random.default_rng(1)
    prints = np.append(rng.integers(0, 1 << 63, 5000).astype(np.uint64), np.uint64(0) + np.arange(3, dtype=np.uint64))
    counts, sizes = np.unique(simhash.quarter_counts(prints), axis=0, return_counts=True)
    layout = simhash.Layout(counts.astype(np.int64), sizes, 20)
    block = layout.block(prints)
    assert np.bincount(block).max() <= 60 and block.max() == len(layout.low) - 1
    c = simhash.quarter_counts(prints)
    assert (layout.low[block] <= c).all() and (c <= layout.high[block]).all()
    for a, b in rng.integers(0, len(prints), (300, 2)):
        if (int(prints[a]) ^ int(prints[b])).bit_count() <= 4:
            assert block[b] in layout.near(int(block[a]), 4)


def test_quantised_rows():
    rows = pa.array([[0.1, -0.1], None, [1.0], [None, 1.0], [float("inf"), 0.0], [1e300, -1e300]], pa.list_(pa.float64()))
    at, x = whitening.quantised(rows, 2)
    assert at.tolist() == [0, 5] and x.tolist() == [[25, -26], [1 << 40, -(1 << 40)]]
    assert whitening._unpacked(pa.array(whitening._packed(x), pa.binary()), 2).tolist() == x.tolist()
    # cut batches keep their offsets
    at, x = whitening.quantised(rows[3:], 2)
    assert at.tolist() == [2]
