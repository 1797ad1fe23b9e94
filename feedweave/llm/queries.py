"""The queries of this package over the given tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op5_token_ids(spark, folder):
    from feedweave.llm import tokens

    path = fresh_dir(spark, "tokens")
    tokens.write_tokens(_table(spark, folder, "documents"), path)
    stored = spark.read.schema(tokens.SCHEMA).orc(path)
    # Sums first: the ids themselves need not meet the places of the files.
    sums = tokens.crc32_of_ids(stored, ["doc_id", "shard", "shard_start", "n_tokens"])
    return tokens.with_start(sums, stored).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op6_packing(spark, folder):
    from feedweave.llm import packing

    pieces = packing.pack(_table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "cost")


@_query
def op2_toxicity(spark, folder):
    from feedweave.llm import toxicity

    docs = _table(spark, folder, "documents")
    model = toxicity.train_on(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(toxicity.held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op4_line_dedup(spark, folder):
    """What is left of every document: length, a digest of its text, and the number of lines cut."""
    from feedweave.llm import lines

    kept = lines.dedup_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"),
                       F.col("lines_removed").cast("long").alias("lines_removed"))


@_query
def op8_jaccard_join(spark, folder):
    from feedweave.llm import jaccard

    found = jaccard.near_classes(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@_query
def op1_html_extraction(spark, folder):
    from feedweave.llm import mincut

    return mincut.extract(_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@_query
def op3_embedding_near_dedup(spark, folder):
    from feedweave.llm import neardup

    return neardup.near_vectors(_table(spark, folder, "embeddings"))


@_query
def op7_source_mixing(spark, folder):
    """Copies of every document, mixed so that sources weigh as the roots of their sizes."""
    from feedweave.llm import mixing

    mixed = mixing.mix_sources(_table(spark, folder, "documents"), exponent=0.5, seed=7)
    return mixed.select("doc_id", "source", F.col("mix_copy").cast("int").alias("mix_copy"), "mix_key",
                        F.md5(F.col("text").cast("binary")).alias("text_md5"))


SQL["op7_source_mixing"] = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (pow(n::DOUBLE, 0.5) * (SELECT sum(n) FROM counts)) / ((SELECT sum(pow(n::DOUBLE, 0.5)) FROM counts) * n) AS rate
  FROM counts),
parts AS (SELECT source, greatest(1, ceil(rate / 4.0)::INT) AS steps, rate / greatest(1, ceil(rate / 4.0)::INT) AS part FROM rates),
cdf AS (
  SELECT source, part, 0 AS k, exp(-part) AS p, exp(-part) AS s FROM parts
  UNION ALL
  SELECT source, part, k + 1, p * part / (k + 1), s + p * part / (k + 1) FROM cdf WHERE k < 39),
drawn AS (
  SELECT doc_id, d.source, d.text,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '~') || '|7|' || step), 1, 13))::BIGINT / 4503599627370496.0 AS u, step
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.steps + 1)) AS t(step)),
numbers AS (
  SELECT d.doc_id, d.source, d.text, d.step, count(c.k) AS n
  FROM drawn d LEFT JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.s <= d.u
  GROUP BY ALL),
totals AS (SELECT doc_id, source, text, sum(n)::BIGINT AS n FROM numbers GROUP BY ALL)
SELECT doc_id, source, copy::INT AS mix_copy, md5(coalesce(doc_id::VARCHAR, '~') || '|order7|' || copy) AS mix_key,
  md5(text) AS text_md5
FROM totals, unnest(range(1, n + 1)) AS t(copy)
"""


@_query
def op9_chat_formatting(spark, folder):
    from feedweave.llm import chat

    turns = _table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    turns = turns.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.format_turns(turns))


@_query
def op10_nearest_neighbours(spark, folder):
    from feedweave.llm import nearest

    vectors = _table(spark, folder, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@_query
def op13_byte_bpe(spark, folder):
    from feedweave.llm import rankqueue

    return rankqueue.digests(rankqueue.encode(_table(spark, folder, "documents")))


@_query
def op11_prefix_trie(spark, folder):
    from feedweave.llm import trie

    return trie.prefix_trie(_table(spark, folder, "conversations"))


SQL["op11_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id::BIGINT AS conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(concat_ws(chr(10), length(role)::VARCHAR, role, text))) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
whole AS (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.part, r.pos) FILTER (r.pos IS NOT NULL), []) AS t
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
nodes AS (
  SELECT t[1:d] AS node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(t) = d), '')) AS ends_sha256
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM whole) GROUP BY ALL),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[depth].text) END AS own
  FROM nodes n LEFT JOIN children c ON n.node = c.node),
below AS (
  SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved AS saved_tokens, v.ends_sha256
FROM valued v JOIN below b ON v.node = b.node LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]
"""


@_query
def op12_source_divergence(spark, folder):
    from feedweave.llm import divergence

    return divergence.audit(_table(spark, folder, "documents"))


SQL["op12_source_divergence"] = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY ALL),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(c.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS total FROM counts GROUP BY ALL) c ON g.lang = c.lang AND g.source = c.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::BIGINT * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p, 1 + 1000000000::BIGINT * (k.n + 1) // (l.total + l.v) AS whole
  FROM groups g JOIN langs l ON g.lang = l.lang JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT s.lang, s.source, t.source AS item, sum((s.p - t.p) * (s.p - t.p) // t.p)::BIGINT AS value
    FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - whole) * (p - whole) // whole AS value FROM shares WHERE n > 0 AND p > whole),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""
