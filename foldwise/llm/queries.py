"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import chat, langid, lm, neardup, packing, pages, pieces, quality, runs, stable, topk, trie, vptree
from foldwise.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

CHAT_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), w AS (
  SELECT *, sum(20 + length(regexp_replace(role || text, '([<\\[\\\\])', 'xx', 'g'))) OVER (PARTITION BY conv_id ORDER BY turn) AS upto,
    turn = max(turn) OVER (PARTITION BY conv_id) AS final
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""

TRIE_SQL = """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM t)
), b AS (
  SELECT i.c, t.r, t.role, t.text FROM ids i JOIN t ON t.c = i.c - i.c % 100 AND t.r <= i.h
  UNION ALL SELECT i.c, t.r + 1000000000, t.role, t.text FROM ids i JOIN t ON t.c = i.c AND t.r > i.h
), p AS (
  SELECT c, row_number() OVER w AS d, length(text) AS chars,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS k
  FROM b WINDOW w AS (PARTITION BY c ORDER BY r)
), m AS (
  SELECT c, 0 AS d, 0 AS chars, '' AS k FROM ids UNION ALL SELECT c, d, chars, k FROM p
), l AS (SELECT c, max(d) AS len FROM m GROUP BY c), n AS (
  SELECT k, d, min(m.c) AS conv, count(*) AS n, any_value(chars) AS chars,
    coalesce(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (d = len), '') AS ends
  FROM m JOIN l USING (c) GROUP BY k, d
), x AS (
  SELECT u.k, u.d, count(*) FILTER (v.d = u.d + 1) AS n_children, sum((v.n - 1) * v.chars) AS saved
  FROM n u JOIN n v ON starts_with(v.k, u.k) AND v.d >= u.d GROUP BY u.k, u.d
), f AS (
  SELECT u.k, u.d, count(*) AS n_leaves FROM n u JOIN n v ON starts_with(v.k, u.k) AND v.d >= u.d
  JOIN x ON x.k = v.k AND x.d = v.d AND x.n_children = 0 GROUP BY u.k, u.d
)
SELECT n.conv AS conv_id, CAST(n.d AS BIGINT) AS depth, q.conv AS parent_conv_id, n.n AS n_convs, x.n_children, f.n_leaves,
  CAST(x.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN x ON x.k = n.k AND x.d = n.d JOIN f ON f.k = n.k AND f.d = n.d LEFT JOIN n q ON q.d = n.d - 1 AND starts_with(n.k, q.k)
"""

STABLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id
), roots AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY vec_id), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, root AS component_id, vec_id = root AS kept FROM roots LEFT JOIN n ON n.a = vec_id
"""


def on_workers(spark: SparkSession) -> SparkSession:
    """Python workers import this package from where the driver does, unless the cluster says otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(on_workers(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"), (F.col("id") == F.col("root")).alias("kept"))


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.tokenise(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), with_ids=False)
    return packing.pack(found)


@query("op3_exact_topk", TOPK_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2).select("doc_id", "quality"))
    return quality.scored(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op7_chat", CHAT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    return chat.digests(turns.unionByName(spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)))


@query("op9_vptree")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20).drop("share")


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.identify(docs, fold("doc_id", 3) != 1)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op4_html")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_language_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold("doc_id", 7)
    out = lm.score(table(spark, sf_dir, "documents"), train=part != 2, deleted=part == 3)
    return out.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations")).drop("last_src", "last_r")


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"))


@query("op13_stable_hashing", STABLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stable.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("root").alias("component_id"), "kept")
