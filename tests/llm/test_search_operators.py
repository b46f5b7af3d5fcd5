"""Language model, joins, neighbours and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import ODD, WORDS, check_packed, odd_docs, texts
from tidewheel.llm import components, curves, idsets, jaccard_join, lm, queries
from tidewheel.llm.common import BATCH_BYTES, bounded_batches, claim, worker_cache
from tidewheel.llm.elias_fano import EliasFano, load, pack, save
from tidewheel.session import run_dir

FOLDER = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Elias-Fano


@pytest.mark.parametrize("n,top", [(1, 10), (3, 3), (5, 1 << 60), (1000, 1 << 40), (5000, 6000)])
def test_successor_search(n, top, tmp_path):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n))
    save(f"{tmp_path}/x", pack(values))
    sequence = EliasFano(load(f"file://{tmp_path}/x"))
    asked = np.concatenate([values, values + 1, rng.integers(0, top, 50), [0, top - 1, top]])
    at, there = sequence.find(asked)
    assert (at == np.searchsorted(values, asked)).all() and (there == np.isin(asked, values)).all()
    assert (sequence.get(np.arange(len(values))) == values).all()
    assert not EliasFano(pack(np.zeros(0, np.int64))).find(asked)[1].any()


# language model


def brute_model(docs, learned, order):
    words = {d: [*WORDS.findall(lowered(t)), None] for d, t in docs}
    one = Counter(w for d in learned for w in words[d])
    total = sum(one.values())
    grams, after = defaultdict(Counter), defaultdict(lambda: defaultdict(list))
    for d in learned:
        seq = [None, *words[d]]
        for k in range(2, order + 1):
            for i in range(k - 1, len(seq)):
                g = tuple(seq[i - k + 1 : i + 1])
                if None not in g[1:-1]:
                    grams[k][g] += 1
    discount = {}
    for k, counts in grams.items():
        a, b = (sum(n == m for n in counts.values()) for m in (1, 2))
        discount[k] = min(0.95, max(0.1, a / (a + 2 * b))) if a else 0.5
        for g, n in counts.items():
            after[k][g[:-1]].append(n)
    rare = min(0.5, max(sum(n == 1 for n in one.values()) / total, 1 / (total + len(one) + 1)))
    base, full = {}, {}
    for d, own in words.items():
        seq, base[d], full[d] = [None, *own], 0.0, 0.0
        for i in range(1, len(seq)):
            w = seq[i]
            base[d] += math.log10((one[w] + 1) / (total + len(one) + 1))
            p = one[w] / total * (1 - rare) if w in one else rare
            for k in range(2, order + 1):
                g = tuple(seq[max(0, i - k + 1) : i + 1])
                if len(g) < k or None in g[1:-1]:
                    break
                if follow := after[k].get(g[:-1]):
                    p = p * discount[k] * len(follow) / sum(follow) + max(0, grams[k][g] - discount[k]) / sum(follow)
            full[d] += math.log10(p)
    return base, full, one


@pytest.mark.parametrize("order,shard", [(2, 4_000_000), (2, 3_000), (3, 5_000)])
def test_model_scores(spark, order, shard):
    docs = texts()
    learned = [d for d, _ in docs if zlib.crc32(str(d).encode()) % 7 != 2]
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    trie = lm.train(df.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2), order, shard)
    base, full, one = brute_model(docs, learned, order)
    assert (trie.total, trie.words) == (sum(one.values()), len(one))
    assert all(len(level.paths) > 1 for level in trie.levels) or shard > 10_000
    for r in lm.score(df, trie).collect():
        assert r.base_score == pytest.approx(base[r.doc_id])
        # sixteen bits per probability, rounded down: less than a step on either of two terms
        step = max(level.decades for level in trie.levels) / (lm.STEPS - 1)
        assert abs(r.score - full[r.doc_id]) <= 2 * step * r.n_tokens * (order - 1) + 1e-6


def test_model_query(spark):
    got = queries.QUERIES["op6_lm_score"](spark, FOLDER).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.n_known == r.n_tokens for r in got if not r.held_out) and all(r.score < 0 for r in got)


def test_model_query_reads_triples(spark):
    got = queries.QUERIES["op6_lm_score"](spark, FOLDER).collect()
    docs = texts()
    _, full, _ = brute_model(docs, [r.doc_id for r in got if not r.held_out], 3)
    _, pairs, _ = brute_model(docs, [r.doc_id for r in got if not r.held_out], 2)
    assert all(r.score == pytest.approx(full[r.doc_id], abs=0.01 + 0.001 * r.n_tokens) for r in got)
    assert sum(full.values()) > sum(pairs.values()) + 1


def test_model_is_a_distribution(spark):
    text = "a b a c a b b d a " * 3
    trie = lm.train(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    outcomes = ["a", "b", "c", "d", "never"]
    docs = [(n, f"a {w} d a") for n, w in enumerate(outcomes)] + [(9, "a")]
    score = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string"), trie).collect()}
    end = score[9]  # probability of "a" and then the end
    first = lm.score(spark.createDataFrame([(0, "")], "doc_id long, text string"), trie).collect()[0].score
    assert end < 0 and first < 0 and all(s < end + 1 for s in score.values())


def test_large_context_is_a_distribution(spark):
    # one word stands before 10.4 million others, nearly all of them once
    rows, each = 400, 26_000
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda i: F.concat(F.lit("a w"), (F.col("id") * each + i).cast("string"))))
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.concat(text, F.lit(" a w0 a w0 a w1")).alias("text"))
    trie = lm.train(docs)
    reader, level = lm.Reader(trie), trie.levels[1]
    a = reader.find(0, lm.tokens(pa.array(["a"]))[0][:1], "count")[0][0]
    mass, found = 0.0, 0
    for path, bound in zip(level.paths, level.bounds):
        arrays, sequence, _ = reader.shard(path)
        shares = arrays["share"][(sequence.get(np.arange(len(arrays["share"]))) + bound) // trie.words == a]
        mass, found = mass + lm.probabilities(shares, level.decades).sum(), found + len(shares)
    left = reader.weights(1, np.array([a]))[0]
    assert found == rows * each and 0.99 < mass + left <= 1 + 1e-9
    # one word that follows once: what the counts give, not a floor
    count = rows * (each + 3)
    one = lm.probabilities(np.array([lm.quantised(np.array([(1 - level.discount) / count]), level.decades)[0]]), level.decades)[0]
    assert one == pytest.approx((1 - level.discount) / count, rel=1e-3)


def test_model_edges(spark):
    docs = odd_docs(spark)
    for learned in (docs, docs.limit(0), docs.where("text is null")):
        got = lm.score(docs, lm.train(learned)).collect()
        assert len(got) == len(ODD)
        assert all(r.n_tokens == len(WORDS.findall(t or "")) + 1 for r, (_, t) in zip(sorted(got, key=str), sorted(ODD, key=str)) if r.doc_id == _)
    assert lm.score(docs.limit(0), lm.train(docs)).count() == 0


# components


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {n: root(n) for a, b in edges for n in (a, b) if a != b}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Jaccard join


def brute_groups(rows, k, percent):
    sets = []
    for _, text in rows:
        w = WORDS.findall(lowered(text))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root(i), []).append(d)
    return Counter((d, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def clusters():
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(60)], []
    for _ in range(4):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(50):
            own = list(base)
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own[: rng.randint(100, 120)] if rng.random() < 0.3 else own)))
    return rows + [(1000 + n if i is None or i < 5 else 2000 + i, t) for n, (i, t) in enumerate(ODD)] + [(None, rows[0][1]), (3, rows[60][1])]


@pytest.mark.parametrize("k,percent,few,block,frequent", [(3, 90, 16, 512, 16), (3, 90, 2, 32, 2), (5, 80, 3, 32, 4)])
def test_groups(spark, monkeypatch, k, percent, few, block, frequent):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = clusters()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("component", F.lit(1))
    got = Counter(tuple(r) for r in jaccard_join.link(df, k, percent).collect())
    assert got == brute_groups(rows, k, percent)


def phrases():
    """Documents of phrases that many have, hardly any two alike, and clusters with more edits than links allow."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    lines = [" ".join(rng.choice(words) for _ in range(7)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(14))) for i in range(150)]
    for _ in range(2):
        base = [rng.choice(words) for _ in range(110)]
        for _ in range(75):
            own = list(base)
            for _ in range(rng.randint(0, 12)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_whole_sets_move_a_few_times(spark, monkeypatch):
    for name, n in (("FEW", 2), ("FREQUENT", 2), ("BLOCK", 16)):
        monkeypatch.setattr(jaccard_join, name, n)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 24, raising=False)
    moved, block_links = spark.sparkContext.accumulator(0), jaccard_join._block_links

    def counted(percent):
        links = block_links(percent)

        def run(block):
            moved.add(sum(map(len, block["tokens"])))
            return links(block)

        return run

    monkeypatch.setattr(jaccard_join, "_block_links", counted)
    rows = phrases()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.link(df).collect())
    assert got == brute_groups(rows, 3, 90)
    assert moved.value <= 3 * sum(n for _, n, _ in got)


def test_join_query(spark):
    got = Counter(tuple(r) for r in queries.QUERIES["op10_jaccard_join"](spark, FOLDER).collect())
    assert got == brute_groups(texts(), 3, 90)


def test_join_empty(spark):
    assert jaccard_join.link(odd_docs(spark).limit(0)).count() == 0
    assert jaccard_join.link(odd_docs(spark).where("text is null")).collect()[0].component_id == 1


@pytest.mark.parametrize("n", range(7))
def test_shingles_of_a_few_words(n):
    words = ["a", "b", "c", "d", "e", "f"][:n]
    own = jaccard_join.shingle_sets(pa.array([" ".join(words)]), 5)
    assert [len(s) for s in own] == [max(min(n, 1), n - 4)]
    # the same as beside a long text
    assert own[0].tolist() == jaccard_join.shingle_sets(pa.array([" ".join(words), "x " * 20]), 5)[0].tolist()


def test_groups_of_one_short_document(spark):
    for n in range(1, 6):
        rows = [(n, " ".join("abcde"[:n]))]
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert Counter(tuple(r) for r in jaccard_join.link(df, 5, 80).collect()) == brute_groups(rows, 5, 80)


def test_overlap_bound_is_safe():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in range(2))
        bound = jaccard_join.overlap_bound(
            len(a), jaccard_join._counts(len(a), jaccard_join.sketch(a)), len(b), jaccard_join._counts(len(b), jaccard_join.sketch(b))
        )
        assert bound >= len(np.intersect1d(a, b))


def test_fine_overlap_bounds_are_safe():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, top))) for top in (20, 300, 3000) for _ in range(12)]
    # many tokens of one bucket: counts of two bytes
    sets += [np.arange(n, dtype=np.uint64) << np.uint64(12) for n in (90, 300, 70_000)]
    sketches = jaccard_join._Sketches(np.array([len(s) for s in sets]), [jaccard_join.fine_sketch(s) for s in sets])
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    bounds = jaccard_join.overlap_bounds(sketches, i, sketches, j)
    for a, b, bound in zip(i.tolist(), j.tolist(), bounds.tolist()):
        assert len(np.intersect1d(sets[a], sets[b])) <= bound <= min(len(sets[a]), len(sets[b]))


# neighbours


def test_neighbours_of_all(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((700, 16)) * rng.uniform(0.5, 2, (700, 1))
    x[300:420] = x[0]  # copies
    rows = [(n, v.tolist()) for n, v in enumerate(x)]
    rows += [(1000, None), (1005, [0.0] * 16), (1010, [None] + [1.0] * 15), (1015, [float("nan")] * 16), (1020, [1.0]), (None, x[1].tolist()), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("v", F.lit(1))
    got = defaultdict(list)
    for r in curves.search(df, F.col("vec_id") % 5 == 0, most=8).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 700, 5))
    for q, found in got.items():
        score = (x * x[q]).sum(axis=1)
        want = sorted((n for n in range(700) if n != q), key=lambda n: (-score[n], n))[:8]
        assert [v for _, v, _ in sorted(found)] == want and [r for r, *_ in sorted(found)] == list(range(1, 9))
        assert all(s == pytest.approx(score[v], abs=1e-12) for _, v, s in found)


def test_neighbours_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select vec_id, embedding from '{folder}/embeddings.parquet' order by 1").fetchall()
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = defaultdict(set)
    # short windows, so that blocks and curves matter at this size
    for r in curves.search(df, F.col("vec_id") % 20 == 0, curves=16, reach=150).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -9
        hits.append(len(got[ids[q]] & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(hits) > 0.8


def test_neighbours_recall_by_default(spark, tmp_path):
    # few curves ask for a longer window than the least one, as many vectors do
    rng = np.random.default_rng(5)
    x = rng.standard_normal((16_000, 64))
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x))})
    pq.write_table(table, f"{tmp_path}/x.parquet")
    got = defaultdict(set)
    for r in curves.search(spark.read.parquet(f"{tmp_path}/x.parquet"), F.col("vec_id") % 40 == 0, curves=2).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, len(x), 40):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbours_empty_and_few(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert curves.search(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert [(r.vec_id, r.score) for r in curves.search(df, F.col("vec_id") == 0).collect()] == [(1, 4.0)]


def test_hilbert_visits_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = cells[np.argsort(curves.hilbert(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


# id filters


def test_without(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).unionByName(spark.createDataFrame([(None, "t")], "doc_id long, text string"))
    dropped = spark.range(0, 2000, 7).select(F.col("id").alias("doc_id"))
    left = [r.doc_id for r in idsets.without(docs, dropped).collect()]
    assert sorted(x for x in left if x is not None) == [i for i in range(2000) if i % 7] and left.count(None) == 1


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34", "en", "s", 5), (-3, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(odd)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        if name != "pack":
            assert after.columns == docs.columns
        before, docs = [tuple(r)[:2] for r in docs.collect()], corpus_pipeline.saved(after, name)
        kept[name] = [tuple(r) for r in docs.collect()]
        if name == "language_id":
            assert {d for d, _ in before} - {r[0] for r in kept[name]} == {-1, -2, -3}
        if name == "near_copies":
            wanted = {c for _, _, c in brute_groups(before, 5, 80)}
            assert {r[0] for r in kept[name]} == wanted and len(kept[name]) == len(wanted)
        if name == "mix_sources":
            assert set(Counter(r[0] for r in kept[name]).values()) <= {1, 2, 3}
    check_packed(docs.collect(), 2048)
    ids = Counter(r[0] for r in kept["mix_sources"])
    assert Counter(r.doc_id for r in docs.where("piece = 0").collect()) == ids


def test_pipeline_workers_take_small_batches(spark, monkeypatch):
    class Measured:
        def ids(self, texts):
            return [np.ones(texts.nbytes >> 16, "<u4")] * len(texts)

    docs = spark.createDataFrame([(n, "en", "s", "w" * 100_000, 100_000) for n in range(60)], "doc_id long, lang string, source string, text string, n_chars int")
    monkeypatch.setattr(corpus_pipeline.packing, "encoder", lambda path, most: Measured())
    lengths = [r.length for r in corpus_pipeline.pack_sequences(spark, docs.coalesce(1), FOLDER).collect()]
    assert len(lengths) == 60 and max(lengths) <= 20
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_copies):
        bounded_batches(spark)
        stage(spark, docs.limit(2), FOLDER)
        assert spark.conf.get(BATCH_BYTES) == corpus_pipeline.BATCH


def test_workers_give_memory_back():
    def held():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) >> 10

    cache = worker_cache()
    cache["texts"] = [bytes([n % 256]) * 4000 for n in range(50_000)]
    some = cache["texts"][::-1000]  # the last among them, so that nothing is given back without being asked to
    full = held()
    claim()
    assert not cache and some and held() < full - 150


def test_copies_are_dropped_by_rows(spark):
    a, b, c = (" ".join(f"{x}{n}" for n in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (None, a), (5, c), (5, c), (None, "only here it stands in the table"), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame([(i, t, n, -1) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row int, component_id int")
    got = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    assert kept == Counter([(1, a), (2, b), (5, c), *rows[6:]]) and all(r.component_id == -1 for r in got.collect())


def test_stages_keep_clashing_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).withColumns({n: F.lit("x") for n in ("_lang", "_closeness", "_lead", "_score", "_toxic", "_shortening", "_row", "copies")})
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and {tuple(r)[5:] for r in after.collect()} == {("x",) * 8}


def test_pipeline_runs_empty(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
