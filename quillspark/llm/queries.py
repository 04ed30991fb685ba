"""The registered queries of the operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import byte_bpe, decontaminate, hard_negatives, line_dedup, mixing, packing, quality_rules, quality_trees, simhash, suffix_dedup, tool_chat, toxicity, vector_codes
from quillspark.llm.common import held_out, read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.remove_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.coalesce(F.length("text"), F.lit(0)).alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op5_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_chat.link_tools(tool_chat.derived_messages(read(spark, sf_dir, "conversations")), tool_chat.TOOLS)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    judged = quality_trees.judge(docs, quality_trees.fit(docs, labels), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = quality_rules.score(docs, quality_rules.fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return decontaminate.summary(marked).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(vector_codes.finite(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", whole.alias("vector"), moved.alias("label")), F.col("vec_id") % 100 == 0, id="vec_id")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), ["doc_id"])
    encoded = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), "ids")
    decoded = byte_bpe.decode(encoded, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_toxicity, op3_mixing, op4_packing, op5_tool_chat, op6_suffix_dedup, op7_simhash, op8_quality_trees, op9_quality_rules, op10_decontaminate, op11_vector_codes, op12_hard_negatives, op13_byte_bpe)
}

_OP1 = r"""
WITH seen AS (
  SELECT line, count(DISTINCT source) AS sites
  FROM (SELECT unnest(string_split(text, chr(10))) AS line, source FROM documents) AS x
  WHERE source IS NOT NULL AND NOT regexp_full_match(line, '[ \t\r]*')
  GROUP BY line HAVING count(DISTINCT source) >= 5
), parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(s.line) AS n_removed, coalesce(string_agg(p.line, chr(10) ORDER BY k) FILTER (WHERE s.line IS NULL), '') AS text
  FROM parts p LEFT JOIN seen s ON p.line = s.line GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, length(text) AS kept_chars, sha256(text) AS kept_sha256 FROM kept
"""

_OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0) AS x
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= size) AS x
), found AS (SELECT p.doc_id, p.i, p.size, v.item_id FROM places p JOIN windows v ON p.size = v.size AND p.gram = v.gram),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) AS x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) AS x GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SOUND = "FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op11_sql(rounds: int = 4) -> str:
    """The Lloyd rounds, written out one after another."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT row, p, any_value(x) AS x, arg_min(e, (far, e)) AS e, min(far) AS far
  FROM (SELECT row, m.p, m.x, e, list_inner_product(m.x, m.x) - 2 * list_inner_product(m.x, c.x) + list_inner_product(c.x, c.x) AS far FROM parts m JOIN c{r} c ON m.p = c.p) AS t GROUP BY row, p
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT p, e, list(v ORDER BY k) AS x FROM (
      SELECT p, e, k, floor(sum(v) / count(*)) AS v FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM a{r}) AS t GROUP BY p, e, k
    ) AS t GROUP BY p, e
  ) AS n ON c.p = n.p AND c.e = n.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v {_SOUND}
), parts AS MATERIALIZED (
  SELECT row, vec_id, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS x FROM kept CROSS JOIN range(4) AS r(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
), {", ".join(steps)},
codes AS (
  SELECT row, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY row
), book AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS codebooks_sha256 FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM c{rounds}) AS t
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN codes USING (row) CROSS JOIN book
"""


_OP11 = _op11_sql()

_OP12 = f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v {_SOUND} AND label IS NOT NULL
), s AS MATERIALIZED (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, b.row AS other_row, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.row <> b.row WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor, anchor_id, other AS positive_id, score AS positive_score, k FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS k FROM s WHERE same) AS t WHERE k <= 5
), n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.other) AS INT) AS rank, s.other AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT * FROM n WHERE rank <= 10
"""

ORACLE = {"op1_line_dedup": _OP1, "op10_decontaminate": _OP10, "op11_vector_codes": _OP11, "op12_hard_negatives": _OP12}
