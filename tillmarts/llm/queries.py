"""The queries of this package and the SQL that states their results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts.llm import (
    disclosure, exact_dedup, html_text, jaccard_join, merkle, mixing, packing, sharding, spelling,
    suffix_dedup, token_output, topk, toxicity,
)
from tillmarts.llm.common import LOWER, UPPER, table
from tillmarts.storage import fresh_path

Run = Callable[[SparkSession, str], DataFrame]

SHARDS = 8


def held_out(key: str = "doc_id"):
    """The fold that labels are never learnt from: CRC-32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(~held_out()))
    scored = toxicity.score_and_locate(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "located")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches into one index, the larger keys first, so the largest of equal texts stays."""
    docs = table(spark, folder, "documents")
    first, last = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    late = F.coalesce(F.col("doc_id") > ((first or 0) + (last or 0)) // 2, F.lit(False))
    index = f"digest_index_{uuid.uuid4().hex}"
    fates = exact_dedup.dedup_in_batches(spark, [docs.filter(late), docs.filter(~late)], index)
    spark.sql(f"DROP TABLE {index}")  # the fates are written; this index was the query's own
    return fates


OP2_SQL = f"""
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS digest FROM documents
), groups AS (
  SELECT digest, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY digest
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.digest AS text_sha256
FROM digests d JOIN groups g ON d.digest = g.digest
"""


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), every_row=True)


OP3_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q, vectors c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.place(table(spark, folder, "documents"), [1.0] * SHARDS)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "token-blocks")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_ids(table(spark, folder, "documents"), path, tokenizer, end_id=0)
    return token_output.read_documents(spark, path)


def op7_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.report(disclosure.find(table(spark, folder, "documents"), everywhere=True))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut(table(spark, folder, "documents"), tokenizer, end_id=1, drops_space=True)
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"), words=4, percent=85)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


#: The source targets as SQL: sources in code-point order, then the water level.
MIX_SQL = """
sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM {table}
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM per
), ordered AS (
  SELECT *, CAST(coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS full_size,
         CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS w_left,
         CAST(sum(source_size) OVER () AS BIGINT) AS all_size
  FROM weighed WINDOW o AS (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST)
), marked AS (
  SELECT *, all_size * 150 - full_size * 200 AS rest,
         CAST(all_size * 150 - full_size * 200 AS DOUBLE) * w >= CAST(source_size AS DOUBLE) * 200 * w_left AS is_full
  FROM ordered
), level AS (
  SELECT rest, w_left FROM marked WHERE NOT is_full ORDER BY full_size LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(source_size * 2 AS DOUBLE)
         ELSE CAST((SELECT rest FROM level) * w AS DOUBLE) / CAST((SELECT w_left FROM level) * 100 AS DOUBLE) END AS target
  FROM marked
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5(concat(coalesce(CAST(s.doc_id AS VARCHAR), 'null'), ':mix')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS draw
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), mixed AS (
  SELECT doc_id, size, source_size, target,
         CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM rated
)"""

OP10_SQL = (
    "WITH " + MIX_SQL.format(table="documents")
    + " SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"
)

def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampers, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(table(spark, folder, "documents"), changed)


#: CRC-32 in SQL: the table of its 256 steps, and a fold of a text's bytes over it.
CRC_TABLE = """
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS steps
)"""


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text, where ``crc`` is joined."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || hex(encode({text})[i + 1:i + 1]) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, crc.steps[1 + xor(c & 255, b)]), 4294967295), 4294967295)"


def _leaf_sql(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes of trees, from the leaves (tree, pos, n, digest) up."""
    return f"""
{name} AS (
  SELECT 0 AS level, tree, pos, n, digest FROM {leaves}
  UNION ALL
  SELECT level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY level, tree, pos // 3, n
)"""


def _fold_sql(name: str, tree: str, start: str) -> str:
    """Rows (row, tree, pos, n, folded, proof) folded level by level."""
    return f"""
{name} AS (
  SELECT 0 AS level, "row", tree, pos, n, folded, proof FROM {start}
  UNION ALL
  SELECT f.level + 1, f."row", f.tree, f.pos // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.folded ELSE t.digest END, '' ORDER BY t.pos)),
    f.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos <> f.pos), '')
  FROM {name} f JOIN {tree} t ON t.level = f.level AND t.tree = f.tree AND t.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.level, f."row", f.tree, f.pos, f.n, f.folded, f.proof
)"""


OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, rows_in AS (
  SELECT row_number() OVER () AS "row", doc_id, coalesce(':' || source, '-') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0
      THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS changed
  FROM documents, crc
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, "row") - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n, leaf AS digest, changed AS folded, '' AS proof
  FROM rows_in
), {_tree_sql("nodes", "leaves")}, {_fold_sql("folds", "nodes", "leaves")}, subroots AS (
  SELECT 'top' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, digest
  FROM nodes WHERE n = 1
), {_tree_sql("top_nodes", "subroots")}, starts AS (
  SELECT f."row", 'top' AS tree, s.pos, s.n, f.folded, f.proof
  FROM folds f JOIN subroots s ON s.source = f.tree WHERE f.n = 1
), {_fold_sql("top_folds", "top_nodes", "starts")}
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(t.proof) AS proof_sha256,
  t.folded AS folded_root, t.folded = r.digest AS verified
FROM leaves l JOIN top_folds t ON t."row" = l."row" AND t.n = 1
JOIN subroots s ON s.source = l.tree JOIN top_nodes r ON r.n = 1
"""

def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.report(table(spark, folder, "documents"))


OP12_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS "row", doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), windows AS (
  SELECT "row", doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM (
    SELECT "row", doc_id, h, unnest(range(n - 49)) AS i FROM texts WHERE n >= 50 AND doc_id IS NOT NULL)
), least AS (
  SELECT w, min(doc_id) AS doc_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT x."row", x.i AS a, x.i + 50 AS b FROM windows x JOIN least l ON l.w = x.w AND l.doc_id < x.doc_id
), opened AS (
  SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY "row" ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    THEN 0 ELSE 1 END AS opens FROM covered
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY "row" ORDER BY a) AS span FROM opened
), spans AS (
  SELECT "row", min(a) AS a, max(b) AS b FROM numbered GROUP BY "row", span
), gaps AS (
  SELECT s."row", s.a, s.b, coalesce(lag(s.b) OVER (PARTITION BY s."row" ORDER BY s.a), 0) AS kept_from FROM spans s
), cut AS (
  SELECT g."row", count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(t.h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept
  FROM gaps g JOIN texts t ON t."row" = g."row" GROUP BY g."row"
)
SELECT t.doc_id, t.n AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(c.kept || substr(t.h, 2 * c.last + 1), t.h))) AS kept_sha256
FROM texts t LEFT JOIN cut c ON c."row" = t."row"
"""


def _misspelt(key, run):
    """One run in 199 without one of its code points, chosen by the CRC-32 of key and run."""
    h = F.crc32(F.concat(key.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), change=_misspelt))


OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')), '{UPPER}', '{LOWER}') AS run FROM documents
), runs AS (
  SELECT doc_id, run, count(*) AS times FROM found GROUP BY ALL
), hashed AS (
  SELECT run, times, {crc32_sql("(CAST(doc_id AS VARCHAR) || ':' || run)")} AS h FROM runs, crc
), spelt AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), holes AS (
  SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT x.word, y.word AS near FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.a || h.b
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.a || h.b
), ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM pairs p JOIN words w ON w.word = p.near
), judged AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
    CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), chain AS (
  SELECT word, word AS at FROM judged
  UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.at WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.at AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word JOIN judged e ON e.word = c.at AND e.form IS NULL
"""

QUERIES: dict[str, Run] = {
    run.__name__: run
    for run in (
        op1_toxicity, op2_exact_dedup, op3_topk_search, op4_html_text, op5_sharding, op6_token_output,
        op7_disclosure, op8_packing, op9_jaccard_join, op10_mixing, op11_merkle_manifest,
        op12_suffix_dedup, op13_spelling_variants,
    )
}
SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op3_topk_search": OP3_SQL,
    "op10_mixing": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_suffix_dedup": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
