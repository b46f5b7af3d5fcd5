"""Operators on texts against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import differences, expected, oracle
from tidewheel.llm import chat, langid, mixing, packing, queries, toxicity, warc, winnowing
from tidewheel.session import run_dir

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "Ünï cödé ½ 日本語 ok, end."), (6, "a b c"), (7, "a b c"),
    (8, "word " * 5000), (9, "x" * 40_000), (10, "A b. C!\x0bd\x85e"), (10, "A b. C!\x0bd\x85e"), (None, "no id at all here"),
]


def odd_docs(spark):
    rows = [(i, t, ["en", "de", None][n % 3], [None, "s1", "s2"][n % 3], -1, "x") for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int, hash string")


def texts():
    return duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet' order by 1").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twins(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    names, _, wanted = expected(oracle(FOLDER), queries.ORACLES[name])
    assert differences(df.columns, [tuple(r) for r in df.collect()], names, wanted) is None


# chat


def test_chat_digests(spark):
    got = {r.conv_id: r for r in queries.QUERIES["op1_chat_format"](spark, FOLDER).collect()}
    turns = defaultdict(list)
    said = "</s>[INST] ok [/INST]"
    for conv, turn, role, text in duckdb.sql(f"select * from '{FOLDER}/conversations.parquet'").fetchall():
        turns[conv].append((turn, role or "", text or ""))
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own.sort()
        r, loss = got[conv], "".join(t for _, role, t in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_is_reversible(spark):
    hard = ["", *chat.CONTROLS, "<\\|turn|>", "<\\\\|over|>x", "[\\INST]", "<|says|><|over|>", "é" * 9, "\n", "a<|over|" + ">", "<<|turn|>"]
    rows = [(7, i, h, h[::-1] + h) for i, h in enumerate(hard)] + [(None, 1, None, None), (8, None, "assistant", "z"), (8, 2, "assistant", "z"), (8, 2, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("clash"))
    pieces = chat.format_chat(df)
    for r in pieces.collect():
        body = r.formatted.replace(chat.TURN, "").replace(chat.SAYS, "").replace(chat.OVER, "")
        assert not any(c in body for c in chat.CONTROLS if c not in (chat.TURN, chat.SAYS, chat.OVER))
    back = chat.read_chat(pieces).orderBy("conv_id", "part", "piece", "place").collect()
    assert [(r.role, r.text) for r in back if r.conv_id == 7] == [(h, h[::-1] + h) for h in hard]
    assert [(r.role, r.text, r.loss) for r in back if r.conv_id is None] == [("", "", None)]
    assert [r.loss for r in back if r.conv_id == 8] == ["z"] * 3


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_chat(df)).count() == 0


# mixing


def test_mix_targets_and_edges(spark):
    sizes = {"a": 1, "b": 100, "c": 500, "d": 1000, None: 50}
    rows = [(n, "w " * k, s) for n, (s, k) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.source: r for r in mixing.mix(docs).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2)))
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while True:  # cut off, share again, until none is above
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s]}
        if not over:
            target.update({s: share * weight[s] for s in free})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    assert {s: r.target for s, r in got.items()} == pytest.approx(target)
    assert all(r.taken <= 3 * r.size and r.taken % r.size == 0 for r in got.values())
    odd = mixing.mix(odd_docs(spark).withColumn("key", F.lit(1)).withColumn("gap_0", F.lit(2))).collect()
    assert len(odd) == len(ODD) and all(r.hash == "x" and r.key == 1 and r.gap_0 == 2 for r in odd)
    assert all(r.taken == 0 for r in odd if r.size == 0)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_comes_near(spark):
    df = queries.QUERIES["op3_mix_sources"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    for r in df.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 0.05 * r.g


# winnowing


def brute_print(text, k=winnowing.K, window=winnowing.WINDOW):
    mask = (1 << 64) - 1
    turn = lambda x, by: ((x << by) | (x >> (64 - by))) & mask if by else x
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORDS.findall(text or "")]
    if not h:
        return []
    grams = []
    for i in range(max(len(h) - k, 0) + 1):
        g = 0
        for j in range(k):
            g ^= turn(h[i + j] if i + j < len(h) else 0, k - 1 - j)
        grams.append(g - (1 << 64) if g >> 63 else g)
    out = []
    for i in range(max(len(grams) - window, 0) + 1):
        own = grams[i : i + window]
        at = max(j for j, g in enumerate(own) if g == min(own))
        if not out or out[-1][0] != i + at:
            out.append((i + at, own[at]))
    return out


def test_fingerprints(spark):
    docs = odd_docs(spark).unionByName(spark.createDataFrame(texts()[:60], "doc_id long, text string"), allowMissingColumns=True)
    for r in docs.select("text", winnowing.fingerprint(F.col("text")).alias("p")).collect():
        assert [tuple(x) for x in r.p] == brute_print(r.text)


def test_shared_runs_are_found():
    rng = random.Random(5)
    for _ in range(30):
        run = [f"r{rng.randrange(50)}" for _ in range(winnowing.K + winnowing.WINDOW - 1)]
        sides = [" ".join([f"{s}{rng.random()}" for _ in range(rng.randrange(9))] + run + [f"{s}{rng.random()}" for _ in range(rng.randrange(9))]) for s in "xy"]
        a, b = ({h for _, h in brute_print(t)} for t in sides)
        assert a & b


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_next_document(spark, pieces):
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = winnowing.with_next(odd_docs(spark), {}, pieces).collect()
    want = Counter((a[0], a[1] or "", b[1] or "") for a, b in zip(rows, rows[1:] + rows[:1]))
    assert Counter((r.doc_id, r.text, r.next_text) for r in got) == want
    one = odd_docs(spark).where("doc_id = 6")
    assert [r.next_text for r in winnowing.with_next(one, {}, pieces).collect()] == ["a b c"]
    assert winnowing.with_next(odd_docs(spark).limit(0), {}, pieces).count() == 0


def test_winnowing_query(spark):
    docs = texts()
    after = dict(zip([d for d, _ in docs], docs[1:] + docs[:1]))
    prints = {d: brute_print(t) for d, t in docs}
    alike = lambda a, b: len({h for _, h in a} & {h for _, h in b}) / len({h for _, h in a + b}) if a + b else 1.0
    own = dict(docs)
    for r in queries.QUERIES["op4_winnowing"](spark, FOLDER).collect():
        text, following = own[r.doc_id], after[r.doc_id]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[1][:quarter]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(prints[r.doc_id], brute_print(edited)))
        assert r.near_next == pytest.approx(alike(prints[r.doc_id], prints[following[0]]))


# language


def brute_lang(text, profiles):
    words = langid.LETTERS.findall((text or "").lower())
    counts = Counter()
    joined = f"_{'_'.join(words)}_"
    for n in (1, 2, 3):
        for i in range(len(joined) - n + 1):
            g = joined[i : i + n]
            if (n == 1 and g == "_") or (n == 3 and g[1] == "_"):
                continue
            counts[g] += 1
    if not words:
        return "und"
    key = lambda g: sum(ord(c) << (21 * i) for i, c in enumerate(reversed(g)))
    top = sorted(counts, key=lambda g: (-counts[g], key(g)))[: langid.COMPARED]
    away = {
        lang: sum(min(abs(ranks[key(g)] - i), langid.PROFILE) if key(g) in ranks else langid.PROFILE for i, g in enumerate(top))
        for lang, ranks in profiles.items()
    }
    return min(sorted(away), key=away.get)


def test_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    profiles = defaultdict(dict)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    for lang, rank, gram in langid.learn(docs.where(~held)).select("lang", "rank", "gram").collect():
        profiles[lang][gram] = rank
    lang = dict(duckdb.sql(f"select doc_id, lang from '{FOLDER}/documents.parquet'").fetchall())
    own = dict(texts())
    got = queries.QUERIES["op5_language_id"](spark, FOLDER).collect()
    assert all(r.lang_pred == brute_lang(own[r.doc_id], profiles) and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.95


def test_language_edges(spark):
    docs = odd_docs(spark)
    got = langid.rate(docs, langid.learn(docs)).collect()
    assert len(got) == len(ODD) and "hash" in got[0]
    assert all((r.lang_pred == "und") == (not langid.LETTERS.search(r.text or "")) for r in got)
    nothing = langid.learn(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.learn(docs)).count() == 0


# packing


def test_packing_query(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = queries.QUERIES["op7_best_fit_packing"](spark, FOLDER).collect()
    want = {}
    for doc, text in texts():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            want[doc, n] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    check_packed(got, 2048)
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-total // 2048) + 1


def check_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity


def test_hard_tokens():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    hard = [t or "" for _, t in ODD] + [
        "İstanbul a<|endoftext|>b é é 'Tis don't x''s ½ ñ̃ ς ΣΑΣ ﬁ \x1c", "b\x85c　d <|startoftext|>. a.. b,, É, ,. <|ENDOFTEXT|>,", "1,2.3 e,. .e",
    ]
    own = packing.encoder(path)
    for _ in range(2):
        for got, text in zip(own.ids(pa.array(hard)), hard):
            assert got.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_rounds_exchange(spark):
    rng = random.Random(2)
    rows = [(n, 0, 0, rng.choice([100, 35, 34, 33, 51, 60, 7, 100]), n) for n in range(600)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").withColumn("slot", F.lit(1))
    got = packing.pack(pieces, capacity=100, group_rows=50).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((r[0], r[3]) for r in rows)
    check_packed(got, 100)
    alone, _ = packing.best_fit(np.array([r[3] for r in rows if r[3] < 100]), 100)
    assert len({r.sequence_id for r in got}) <= sum(r[3] == 100 for r in rows) + alone.max() + 1 + 4
    assert packing.pack(pieces.limit(0)).count() == 0


def test_lower_bound_holds():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(1, 101, rng.integers(1, 40))
        bins, offsets = packing.best_fit(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= bins.max() + 1
    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([34] * 6), 100) == 3
    assert packing.lower_bound(np.zeros(0, int), 100) == 0


# archives


def test_archives(spark):
    big = "".join(chr(0x100 + i % 500) for i in range(70_000))
    rows = [
        (1, "http://a/\r\nx y", big), (2, None, big), (3, "u", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9), (4, "u", None),
        (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "0\r\n\r\n" * 30), (8, "u", "0\r\n\r\n" * 30), (0, "u", "0\r\n\r\n" * 30), (None, "u", "z" * 200),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("first", F.lit(0))
    path = run_dir(spark, "archive")
    warc.write_warc(pages, path, segment_bytes=10_000, records_per_file=3)
    got = warc.read_warc(spark, path).collect()
    assert all(r.valid for r in got) and len(got) == len(rows)
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if h == html and p is not None), default=None)
        again = len(data) >= 100 and page != first
        want[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert found == want
    payload = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert bytes(payload[1]).decode() == big
    # a missing segment shows
    records = warc.read_records(spark, path).where("segment is not null and record_type = 'continuation'")
    assert records.count() > 10
    empty = run_dir(spark, "archive")
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_broken_framing():
    assert warc.unchunked(warc.chunked(b"abc" * 9999)) == b"abc" * 9999
    assert warc.unchunked(b"5\r\nabc") is None and warc.unchunked(b"zz\r\n") is None and warc.unchunked(b"") is None


# toxicity


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op9_toxicity"](spark, folder).collect()}
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{folder}/labels.parquet'").fetchall())
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    caught = [got[d].predicted for d in held if labels[d] == 1]
    flagged = [got[d].predicted for d in held if labels[d] == 0]
    # some of this table's stretches stand in ordinary documents too
    assert np.mean(caught) > 0.7 and np.mean(flagged) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_toxic_stretches_that_begin_alike():
    """Each stands in the dictionary, so each has to shorten its words, whichever others begin with the same letters."""
    stretches = [f" ve{c}u" for c in "abcdfgjlmpqrst"]
    base = b" ".join(b"%d ordinary words" % n for n in range(200))
    toxic = base + b"".join(toxicity.START + s.encode() for s in stretches)
    distance = toxicity.Distance(toxicity.Model(base, toxic, base, (0.0,) * 11))
    assert all(distance.of(s.strip() + "xyz") & 255 >= 4 for s in stretches)


def test_toxicity_edges(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    for own in (labels, labels.where("toxic = 0"), labels.limit(0)):
        got = toxicity.rate(docs, toxicity.fit(docs, own)).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_warc_query_cuts_pages(spark, monkeypatch):
    paths, write, read = [], warc.write_warc, warc.read_warc
    monkeypatch.setattr(warc, "write_warc", lambda pages, path, **k: (paths.append(path), write(pages, path, **k)))
    queries.QUERIES["op8_warc"](spark, FOLDER)
    assert warc.read_records(spark, paths[0]).where("record_type = 'continuation'").count() > 0
    monkeypatch.setattr(warc, "read_warc", lambda *a: read(*a).withColumn("valid", F.lit(False)))
    with pytest.raises(Exception, match="put together"):
        queries.QUERIES["op8_warc"](spark, FOLDER).collect()


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_other_tokenizers(file):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(file)
    own = [t or "" for _, t in texts()[:60]] + [t or "" for _, t in ODD]
    whole = Tokenizer.from_file(path)
    got = packing.encoder(path, 1000).ids(pa.array(own))
    assert [g.tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in own]


def test_repeated_pieces_are_dealt_out(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(9).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    placed = packing.pack(rows, capacity=100, group_rows=300, rounds=1)
    groups = placed.groupBy(F.shiftright("sequence_id", 24)).count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 500 and placed.count() == 3000


def test_profiles_are_limited_early(spark):
    plan = langid.learn(odd_docs(spark).withColumn("lang", F.lit("en")))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
