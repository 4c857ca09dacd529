"""The queries ``op1_...`` to ``op13_...``: each operator over its whole table, with its digest columns.

A query's result is a written table: it is made under settings that bound what Python gets at
once, and the session has its own settings again when the query returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import heap_lloyd, interpolated_lm, jaccard_join, language_id, merge_replay, name_join, packing, personal_spans, quality_crf, tool_calls, toxicity, url_filter, vector_dedup
from tidemark.llm.common import fold, stored, table

RULES = [
    url_filter.Rule("com/en/", "block"),
    url_filter.Rule("example.com/en/7", "allow"),
    url_filter.Rule("net/de/", "allow"),
    url_filter.Rule("example.net/de/8", "block"),
    url_filter.Rule("org/es/", "block"),
]
LENGTH = 2048


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES), "op1", rows=10_000)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks of ``byte_bpe_50k.tiktoken`` are the vocabulary of ``byte_bpe_50k.json``; a test compares their ids."""
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, length=LENGTH)
    return packing.pack(pieces, length=LENGTH)


def op3_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = merge_replay.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False, digests=True)
    return stored(encoded, "op3")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2))
    return stored(toxicity.score(documents, model, also={"held_out": fold("doc_id", 4) == 2}), "op4")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return stored(quality_crf.judge(documents, quality_crf.fitted(documents, table(spark, sf_dir, "labels"))), "op5")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    prototypes = language_id.learn(documents.where(fold("doc_id", 5) != 0))
    return stored(language_id.predict(documents, prototypes, also={"held_out": fold("doc_id", 5) == 0}), "op7")


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read as tool use: a user's turn calls ``reply``, and the next turn, if the assistant's, is its result.

    The identifier is ``conv_id:turn`` of the call; a call needs the one two turns before it. All
    other turns are messages of their own.
    """
    turns = table(spark, sf_dir, "conversations")
    ident = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    calls = turns.where("role = 'user'").select(
        "conv_id",
        ident(0).alias("call_id"),
        F.col("turn").alias("position"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
        F.array(ident(2)).alias("needs"),
    )
    results = turns.where("role = 'assistant'").select("conv_id", ident(1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    out = tool_calls.link(calls, results, {"reply": {"text": ("string", True), "turn": ("number", True)}})
    return _with_other_turns(out.withColumn("errors", F.array_join("errors", ",")), turns)


def _with_other_turns(linked: DataFrame, turns: DataFrame) -> DataFrame:
    """Turns that are neither call nor result are messages of their own; ``status`` says whose."""
    rest = turns.where(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))).select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        F.col("turn").alias("position"),
        F.lit(None).cast("int").alias("level"),
        F.when(F.col("role") == "system", "system").when(F.col("role").isNull(), "no_role").otherwise("other_role").alias("status"),
        F.lit(0).cast("long").alias("n_results"),
        F.lit("").alias("errors"),
        F.to_json(F.struct("role", "text")).alias("message"),
    )
    return linked.unionByName(rest)


def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans.find(table(spark, sf_dir, "documents"))


def op12_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients against vendors whose names are misspelt by a digest of their ids."""
    vendors = table(spark, sf_dir, "vendors").select("vendor_id", name_join.misspelt(F.col("name"), F.col("vendor_id")).alias("name"))
    return name_join.join_names(table(spark, sf_dir, "clients").select("client_id", "name"), vendors, most=2)


def op13_heap_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_lloyd.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


QUERIES = {
    f.__name__: f
    for f in (op1_url_filter, op2_best_fit_packing, op3_merge_replay, op4_toxicity, op5_quality_crf, op6_jaccard_join, op7_language_id, op8_tool_calls, op9_interpolated_lm, op10_vector_dedup, op11_personal_spans, op12_name_join, op13_heap_lloyd)
}

#: crc32 of an id's decimal text: each byte's value and seven zeros take one step of the division each.
_CRC_SQL = "xor(list_reduce(flatten(list_transform(string_split(coalesce(CAST({id} AS VARCHAR), ''), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295), 4294967295)"


def _cell_sql(o: int) -> str:
    """Cell (i, i + o - 2) of the next row; ``p`` is the row before it, ``q`` the one before that."""
    j = f"(i + 1 + {o - 2})"
    ways = [f"p{o} + CAST(a[i + 1] <> b[{j}] AS INTEGER)"] + [f"n{o - 1} + 1"] * (o > 0) + [f"p{o + 1} + 1"] * (o < 4)
    ways.append(f"CASE WHEN i >= 1 AND {j} > 1 AND a[i + 1] = b[{j} - 1] AND a[i] = b[{j}] THEN q{o} + 1 ELSE 9 END")
    return f"CASE WHEN {j} < 0 OR {j} > len(b) THEN 9 WHEN {j} = 0 THEN i + 1 ELSE least(9, {', '.join(ways)}) END AS n{o}"


_NAME_SQL = f"""
WITH RECURSIVE
h AS (SELECT vendor_id, name, {_CRC_SQL.format(id="vendor_id")} AS h, length(name) AS n FROM vendors WHERE name <> ''),
v AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN concat(substring(name, 1, h % (n - 1)), substring(name, h % (n - 1) + 2, 1), substring(name, h % (n - 1) + 1, 1), substring(name, h % (n - 1) + 3)) ELSE name END AS name FROM h),
pairs AS (SELECT c.name AS cn, v.name AS vn, string_split(c.name, '') AS a, string_split(v.name, '') AS b
  FROM (SELECT DISTINCT name FROM clients WHERE name <> '') c JOIN (SELECT DISTINCT name FROM v) v ON abs(length(c.name) - length(v.name)) <= 2),
d AS (SELECT cn, vn, a, b, 0 AS i, 9 AS p0, 9 AS p1, 0 AS p2, 1 AS p3, 2 AS p4, 9 AS q0, 9 AS q1, 9 AS q2, 9 AS q3, 9 AS q4 FROM pairs
  UNION ALL SELECT cn, vn, a, b, i + 1, n0, n1, n2, n3, n4, p0, p1, p2, p3, p4
  FROM (SELECT *, {', '.join(_cell_sql(o) for o in range(5))} FROM d WHERE i < len(a)) WHERE least(n0, n1, n2, n3, n4) <= 2),
near AS (SELECT cn, vn, [p0, p1, p2, p3, p4][len(b) - len(a) + 3] AS distance FROM d WHERE i = len(a))
SELECT v.vendor_id, CAST(distance AS INTEGER) AS distance, count(*) AS n_clients, min(client_id) AS first_client_id,
  CAST(sum({_CRC_SQL.format(id="client_id")}) AS BIGINT) AS clients_crc
FROM near JOIN clients c ON c.name = near.cn JOIN v ON v.name = near.vn WHERE distance <= 2 GROUP BY 1, 2
"""



def _rounds_sql(rounds: int) -> str:
    """Assignments ``a0`` ... of all parts, each by the codebooks ``c0`` ... before it. Sums of products are whole numbers that doubles hold."""
    dot = "list_inner_product"
    out = []
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, min({{'d': {dot}(p.x, p.x) - 2 * {dot}(p.x, c.x) + {dot}(c.x, c.x), 'e': e}}) AS near, any_value(p.x) AS x
  FROM p JOIN c{r} c USING (part) GROUP BY vec_id, part)""")
        out.append(f"""c{r + 1} AS MATERIALIZED (SELECT part, e, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT part, e, list(floor(s / n) ORDER BY j) AS x FROM (
    SELECT part, near.e AS e, j, sum(x[j]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM a{r}) GROUP BY ALL) GROUP BY ALL) n USING (part, e))""")
    return ",\n".join(out[:-1])


_CODE_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor(1024 * CAST(y AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM (SELECT *, unnest(range(4)) AS part FROM k)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x FROM p QUALIFY e < 256),
{_rounds_sql(4)},
codes AS (SELECT vec_id, string_agg(lpad(lower(to_hex(near.e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM a4 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, e)) AS digest FROM c4)
SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM k JOIN codes USING (vec_id), book
"""

ORACLE_SQL = {
    "op8_tool_calls": """
WITH RECURSIVE
c AS (SELECT conv_id, concat(conv_id, ':', turn) AS call_id, concat(conv_id, ':', turn - 2) AS need, turn AS position, text FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, concat(conv_id, ':', turn - 1) AS call_id, min({'p': turn, 'c': text}) AS one, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY ALL),
l AS (SELECT DISTINCT call_id, 0 AS level FROM c WHERE need NOT IN (SELECT call_id FROM c)
      UNION SELECT c.call_id, l.level + 1 FROM c JOIN l ON c.need = l.call_id)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.position, r.one.p) AS position,
  CAST(l.level AS INTEGER) AS level,
  CASE WHEN c.call_id IS NULL THEN 'orphan_result' WHEN c.text IS NULL THEN 'invalid_arguments' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
  CAST(coalesce(r.n, 0) AS BIGINT) AS n_results,
  CASE WHEN c.call_id IS NOT NULL AND c.text IS NULL THEN 'text' ELSE '' END AS errors,
  '{' || concat_ws(',',
    CASE WHEN c.call_id IS NOT NULL THEN '"arguments":{' || coalesce('"text":' || CAST(to_json(c.text) AS VARCHAR) || ',', '') || '"turn":' || c.position || '}' END,
    '"id":"' || coalesce(c.call_id, r.call_id) || '"',
    CASE WHEN c.call_id IS NOT NULL THEN '"name":"reply"' END,
    '"result":' || CAST(to_json(r.one.c) AS VARCHAR)) || '}' AS message
FROM c FULL OUTER JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id LEFT JOIN l ON l.call_id = c.call_id
UNION ALL
SELECT conv_id, NULL, turn, NULL, CASE WHEN role IS NULL THEN 'no_role' WHEN role = 'system' THEN 'system' ELSE 'other_role' END, 0, '',
  '{' || concat_ws(',', '"role":' || CAST(to_json(role) AS VARCHAR), '"text":' || CAST(to_json(text) AS VARCHAR)) || '}'
FROM conversations WHERE coalesce(role NOT IN ('user', 'assistant'), true)
""",
    "op12_name_join": _NAME_SQL,
    "op13_heap_lloyd": _CODE_SQL,
}
