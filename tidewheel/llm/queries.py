"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import (
    chat, curves, jaccard_join, langid, lm, merkle, mixing, packing, simhash, toxicity, warc, whitening, winnowing,
)
from tidewheel.llm.common import fold, table
from tidewheel.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Levels of the language model: words, pairs and triples.
LM_ORDER = 3
#: Small enough for pages of the test tables to be cut.
SEGMENT_BYTES = 1 << 13


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _escaped(column: str) -> str:
    return f"regexp_replace({column}, '{chat.ESCAPE}', '\\1\\\\\\2\\3', 'g')"


CHAT_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(n)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({sum(map(len, (chat.TURN, chat.SAYS, chat.OVER)))} + length({_escaped("role")}) + length({_escaped("text")}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op1_chat_format", CHAT_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold nothing but control strings."""
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.conversation_digests(chat.format_chat(turns))


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS hash
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         3 * source_size AS most
  FROM totals
), ranked AS (
  SELECT *, row_number() OVER w AS place,
         ((SELECT sum(source_size) FROM totals) - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed WINDOW w AS (ORDER BY most::DOUBLE / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size,
         least(most::DOUBLE, (SELECT arg_min(share, place) FROM ranked WHERE share * weight <= most) * weight) AS target
  FROM ranked
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets
), budgets AS (
  SELECT *, floor(target - whole * source_size)::BIGINT AS gap FROM planned
), p0 AS (
  SELECT s.*, b.source_size, b.target, b.whole, b.gap, FALSE AS chosen
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)"""
_FITS = "size > 0 AND NOT chosen AND size <= gap"
for _n in range(mixing.PASSES):
    MIX_SQL += f"""
, q{_n} AS (
  SELECT *, sum(CASE WHEN {_FITS} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY hash) AS upto FROM p{_n}
), r{_n} AS (
  SELECT *, {_FITS} AND upto <= gap AS now FROM q{_n}
), p{_n + 1} AS (
  SELECT * EXCLUDE (upto, now) REPLACE (chosen OR now AS chosen, gap - sum(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap)
  FROM r{_n}
)"""
MIX_SQL += f"""
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN whole + chosen::INT ELSE 0 END::BIGINT AS copies,
       (size * CASE WHEN size > 0 THEN whole + chosen::INT ELSE 0 END)::BIGINT AS taken
FROM p{mixing.PASSES}
"""


@query("op3_mix_sources", MIX_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


@query("op4_winnowing")
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = winnowing.with_next(table(spark, sf_dir, "documents"), {"print": winnowing.fingerprint(F.col("text"))})
    changed = docs.withColumn("edited", winnowing.edited(F.col("text"), F.col("next_text")))
    changed = changed.withColumn("edited_print", winnowing.fingerprint(F.col("edited")))
    return changed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnowing.digest(F.col("print")).alias("fingerprint"), winnowing.digest(F.col("edited_print")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        winnowing.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    profiles = langid.fit(docs.where(~held_out))
    return langid.predict(docs, profiles).withColumn("held_out", held_out)


@query("op8_warc", """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM pages)
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path, segment_bytes=SEGMENT_BYTES)
    whole = F.when(F.col("valid"), F.col("page_id")).otherwise(F.raise_error(F.lit("a page was not put together again")).cast("long"))
    return warc.read_warc(spark, path).select(whole.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 4) == 2
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs, model).withColumn("held_out", held_out)


@query("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    trie = lm.train(docs.where(~held_out), LM_ORDER)
    return lm.score(docs, trie).withColumn("held_out", held_out).withColumn("train_tokens", F.lit(trie.total).cast("long"))


@query("op10_jaccard_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) >= 3
           THEN list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams
  FROM w
), g AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, (SELECT min(y) FROM reached WHERE x = doc_id) AS component_id FROM s
""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"))


@query("op2_hilbert_neighbours")
def op2_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
#: CRC-32 of the decimal digits: a byte is mixed in, then eight times one bit is shifted out.
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
         lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""
MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.replace("{n}", "n_chars")} AS leaf, {_LEAF.replace("{n}", "(n_chars + 1)")} AS changed,
         doc_id IS NOT NULL AND {_CRC} % 7 = 0 AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total
  FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, total, leaf AS hash FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, max((total + 1) // 2), sha256(string_agg(hash, '' ORDER BY pos)) FROM nodes
  WHERE total > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, level AS height, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS total
  FROM nodes WHERE total = 1
), tops AS (
  SELECT 0 AS level, pos, total, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, max((total + 1) // 2), sha256(string_agg(hash, '' ORDER BY pos)) FROM tops
  WHERE total > 1 GROUP BY level, pos // 2
), full_rows AS (
  SELECT p.*, s.height, s.subroot, s.pos AS place, (SELECT max(level) FROM tops) AS top, (SELECT hash FROM tops WHERE total = 1) AS root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
), steps AS (
  SELECT f.lang, f.pos AS leaf_pos, unnest(range(height + top)) AS step, f.height, f.pos, f.place FROM full_rows f
), siblings AS (
  SELECT s.lang, s.leaf_pos, s.step, s.pos >> s.step AS node, n.hash FROM steps s
  LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM s.lang AND n.level = s.step AND n.pos = xor(s.pos >> s.step, 1) WHERE s.step < s.height
  UNION ALL
  SELECT s.lang, s.leaf_pos, s.step, s.place >> (s.step - s.height), t.hash FROM steps s
  LEFT JOIN tops t ON t.level = s.step - s.height AND t.pos = xor(s.place >> (s.step - s.height), 1) WHERE s.step >= s.height
), folded AS (
  SELECT lang, pos AS leaf_pos, 0 AS step, CASE WHEN tampered THEN changed ELSE leaf END AS hash FROM full_rows
  UNION ALL
  SELECT f.lang, f.leaf_pos, f.step + 1,
         sha256(CASE WHEN s.node % 2 = 0 THEN f.hash || coalesce(s.hash, '') ELSE coalesce(s.hash, '') || f.hash END)
  FROM folded f JOIN siblings s ON s.lang IS NOT DISTINCT FROM f.lang AND s.leaf_pos = f.leaf_pos AND s.step = f.step
), proofs AS (
  SELECT lang, leaf_pos, sha256(coalesce(string_agg(hash, '' ORDER BY step), '')) AS proof FROM siblings GROUP BY lang, leaf_pos
)
SELECT f.doc_id, f.leaf, f.subroot, f.root, coalesce(p.proof, sha256('')) AS proof_sha256, g.hash AS folded_root, g.hash = f.root AS verified
FROM full_rows f
JOIN folded g ON g.lang IS NOT DISTINCT FROM f.lang AND g.leaf_pos = f.pos AND g.step = f.height + f.top
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM f.lang AND p.leaf_pos = f.pos
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda n: merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang")], n, F.col("text"))
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf(F.col("n_chars") + 1))
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), changed.alias("changed"))
    listed = merkle.manifest(leaves, "lang", "doc_id")
    folded = merkle.fold(F.coalesce("row.changed", "row.leaf"), F.col("path"))
    proved = listed.select("row.doc_id", "row.leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query("op13_simhash")
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))
