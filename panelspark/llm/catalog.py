"""Queries of this folder's operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, jaccard, licenses, line_dedup, mixing, toxicity, transcripts, transport_stream, wrapper
from .common import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary() -> tuple[str, str]:
    """The rank file's path and the split pattern."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable(table(spark, sf_dir, "embeddings"))
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = transport_stream.to_media(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return transport_stream.digest(transport_stream.from_media(stored))


def bpe_digest(docs: DataFrame) -> DataFrame:
    path, pattern = vocabulary()
    coded = bpe.round_trip(docs.select("doc_id", "text"), path, pattern)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    model = transcripts.fit(turns.where(~transcripts.held_out(F.col("conv_id"))))
    return transcripts.digest(transcripts.parse_turns(turns.select("conv_id", "turn", "text"), model))


QUERIES = {f.__name__: f for f in (op1_nearest_neighbours, op2_license_scan, op3_main_text, op4_line_dedup, op5_media_columns, op6_byte_bpe, op7_toxicity, op8_jaccard_join, op9_mixing, op10_chat_format)}

LINE_DEDUP_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents
), t AS (SELECT doc_id, line_no, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM l
), d AS (SELECT line, min({'a': doc_id, 'b': line_no}) AS loc, length(line) AS n FROM t WHERE line <> '' GROUP BY line
), k AS (
  SELECT line, loc, n AS m, 0 AS side, substr(line, 1, n // 2) AS half FROM d
  UNION ALL SELECT line, loc, n, 1, substr(line, n // 2 + 1) FROM d
  UNION ALL SELECT line, loc, n - 1, 0, substr(line, 1, (n - 1) // 2) FROM d
  UNION ALL SELECT line, loc, n - 1, 1, substr(line, (n - 1) // 2 + 2) FROM d
), near AS (
  SELECT DISTINCT x.line FROM k x JOIN k y ON x.m = y.m AND x.side = y.side AND x.half = y.half AND y.loc < x.loc
  WHERE CASE length(x.line) - length(y.line)
    WHEN 0 THEN len(list_filter(range(1, length(x.line) + 1), lambda i: substr(x.line, i, 1) <> substr(y.line, i, 1))) = 1
    WHEN 1 THEN list_contains(list_transform(range(1, length(x.line) + 1), lambda i: substr(x.line, 1, i - 1) || substr(x.line, i + 1)), y.line)
    WHEN -1 THEN list_contains(list_transform(range(1, length(y.line) + 1), lambda i: substr(y.line, 1, i - 1) || substr(y.line, i + 1)), x.line) ELSE false END
), m AS (
  SELECT t.*, t.line <> '' AND (near.line IS NOT NULL OR {'a': t.doc_id, 'b': t.line_no} <> d.loc) AS gone, t.line <> '' AND near.line IS NOT NULL AS is_near
  FROM t LEFT JOIN d ON t.line = d.line LEFT JOIN near ON t.line = near.line
), s AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY line_no) FILTER (NOT coalesce(gone, false)) AS kept, count(*) FILTER (line <> '') AS n_lines,
         count(*) FILTER (gone) AS n_dropped, count(*) FILTER (is_near) AS n_near FROM m GROUP BY doc_id
)
SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near
FROM documents LEFT JOIN s ON documents.doc_id = s.doc_id
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS xn, y.n AS yn, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY ALL
), link AS (SELECT a, b FROM shared WHERE 100 * c >= 80 * (xn + yn - c)
), reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.node, link.b FROM reach JOIN link ON reach.seen = link.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(reach.seen) AS component_id FROM s JOIN reach ON s.doc_id = reach.node GROUP BY s.doc_id, s.s
"""

MIXING_SQL = r"""
WITH r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), src AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM r GROUP BY source
), p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place, sum(source_size) OVER () AS total FROM src
), q AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM p
), o AS (SELECT *, source_size * 3.0::DOUBLE / weight AS ratio FROM q
), c AS (
  SELECT *, (total - coalesce(sum(source_size * 3) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), v AS (SELECT level AS l FROM c WHERE ratio > level ORDER BY ratio, place LIMIT 1
), t AS (SELECT source, source_size, docs, CASE WHEN l IS NULL OR ratio <= l THEN source_size * 3.0::DOUBLE ELSE l * weight END AS target FROM c LEFT JOIN v ON true
), st AS (SELECT *, ceil(docs / 4096.0)::BIGINT AS n_shards, round(sum(target) OVER () / 32)::BIGINT AS seats, sum(target) OVER () AS votes, count(*) OVER () AS n FROM t
), sq AS (
  SELECT source, target, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source IS NOT NULL, source) AS pos, seats
  FROM (SELECT *, unnest(range(0, ceil(seats * target / votes)::BIGINT + n + 2)) AS k FROM st WHERE target > 0)
), won AS (SELECT source, count(*) AS blocks FROM sq WHERE pos <= seats GROUP BY source
), a AS (SELECT st.*, coalesce(blocks, 0) AS blocks FROM st LEFT JOIN won ON st.source IS NOT DISTINCT FROM won.source
), d AS (
  SELECT r.*, a.source_size, a.target, a.blocks, ('0x' || substr(md5('mix-1|shard|' || coalesce(r.doc_id::VARCHAR, '')), 1, 8))::BIGINT % a.n_shards AS shard,
    ('0x' || substr(md5('mix-1|order|' || coalesce(r.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u
  FROM r JOIN a ON r.source IS NOT DISTINCT FROM a.source
), sh AS (SELECT source, shard, blocks, sum(size)::BIGINT AS words, sum(sum(size)) OVER (PARTITION BY source) AS votes, count(*) OVER (PARTITION BY source) AS n FROM d GROUP BY source, shard, blocks
), hq AS (
  SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k + 1) DESC, shard) AS pos
  FROM (SELECT *, unnest(range(0, ceil(blocks * words / votes)::BIGINT + n + 2)) AS k FROM sh WHERE words > 0)
), hw AS (SELECT source, shard, count(*) AS quota FROM hq WHERE pos <= blocks GROUP BY source, shard
), z AS (
  SELECT d.*, sh.words, least(coalesce(quota, 0) * 32, sh.words * 3) AS w, sum(d.size) OVER (PARTITION BY d.source, d.shard ORDER BY d.u, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
  FROM d JOIN sh ON d.source IS NOT DISTINCT FROM sh.source AND d.shard = sh.shard LEFT JOIN hw ON d.source IS NOT DISTINCT FROM hw.source AND d.shard = hw.shard
)
SELECT doc_id, size, source_size, target, CASE WHEN words > 0 THEN (w // words) * size + greatest(0, least(size, w % words - (last - size))) ELSE 0 END::BIGINT AS taken FROM z
"""

SQL = {"op4_line_dedup": LINE_DEDUP_SQL, "op8_jaccard_join": JACCARD_SQL, "op9_mixing": MIXING_SQL}
