"""The operators over the given tables, by query name, and SQL twins where there are any."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.llm.common import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = shipped
    return shipped


@query
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents kept: doc_id, log_weight, gumbel_score."""
    from claimweft.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query
def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.sharding import histogram_sort, text_size

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return histogram_sort(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE["op8_segment_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op8_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, every_row=True)


#: (verdict, host, path), fixed values.
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


@query
def op9_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.urlfilter import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op2_typed_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.chatformat import format_turns, read_back, text_parts

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    messages = rows.unionByName(more).withColumn("parts", text_parts("text"))
    return read_back(format_turns(messages))


@query
def op3_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from claimweft.llm.tokencount import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "keeper")


@query
def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.secretscan import scan, train

    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))


@query
def op4_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.leaks import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_window_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from claimweft.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLE["op12_dense_blocks"] = f"""
WITH words AS (
  SELECT r, doc_id, {_TERMS} FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), sizes AS (
  SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_own FROM words GROUP BY r
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(n_own) AS BIGINT) AS n_terms FROM sizes
), tfs AS (
  SELECT r, term, count(*) AS tf FROM words GROUP BY r, term
), dfs AS (
  SELECT term, count(*) AS df FROM tfs GROUP BY term
), asked AS (
  SELECT i, item_id, term, count(*) AS q
  FROM (SELECT i, item_id, {_TERMS} FROM (SELECT row_number() OVER () AS i, * FROM (SELECT DISTINCT item_id, text FROM benchmark)))
  GROUP BY i, item_id, term
), scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(q * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n_own * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN dfs USING (term) JOIN tfs USING (term) JOIN sizes USING (r) CROSS JOIN totals
  GROUP BY i, item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""


@query
def op12_dense_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 of the decimal conv_id, bit by bit: a code point goes in, then eight shifts (-1).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

ORACLE["op13_depth_band_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS source, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
), turns AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = c.source AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h
), lists AS (
  SELECT conv_id, coalesce(x, CAST([] AS STRUCT(role VARCHAR, text VARCHAR)[])) AS x
  FROM c LEFT JOIN (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, place) AS x FROM turns GROUP BY conv_id) USING (conv_id)
), members AS (
  SELECT conv_id, d AS depth, x[1:d] AS node, len(x) = d AS ends FROM (SELECT *, unnest(range(len(x) + 1)) AS d FROM lists)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended
  FROM members GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(nodes.node[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM nodes LEFT JOIN children ON nodes.node = children.node
), totals AS (
  SELECT node[1:d] AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT node, leaf, saved, unnest(range(depth + 1)) AS d FROM valued) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ended) AS ends_sha256
FROM valued v JOIN totals ON v.node = totals.node LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1]
"""


@query
def op13_depth_band_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweft.llm.trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")


def load_pipeline() -> None:
    """The pipeline module stands at the repository's top and imports the operators."""
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


load_pipeline()
