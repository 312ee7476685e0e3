"""Registered queries of the text operators, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.alignment import align_tokens
from millrace.llm.bpe import bpe_encode
from millrace.llm.conversations import repair_report
from millrace.llm.embedding_dedup import embedding_components
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.line_dedup import line_dedup
from millrace.llm.lm_score import lm_scores
from millrace.llm.mixing import mix_sources
from millrace.llm.packing import pack_documents
from millrace.llm.quality import quality_scores
from millrace.llm.secrets import MODEL_KIND, secret_scan, span_text
from millrace.llm.simhash import simhash_components
from millrace.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chunks", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_table(spark, sf_dir, "embeddings"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = secret_scan(_table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != MODEL_KIND)
    return scan.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    spans = F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return out.select(
        "doc_id",
        "held_out",
        "score",
        "predicted",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join(spans, ",").alias("sentences"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(_table(spark, sf_dir, "documents")).drop("ids")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(_table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


LLM_QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality": op5_quality,
    "op6_mix_sources": op6_mix_sources,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_lm_score": op9_lm_score,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit_packing": op13_best_fit_packing,
}

#: Lower-casing of A to Z alone.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LLM_ORACLES = {
    "op1_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id AS id, text FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT row, id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM docs),
marks AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AS long
  FROM lines),
cuts AS (
  SELECT *, (coalesce(lag(h) OVER w, 0) * 1000003 + h) % 4294967296 % 2 = 0 OR long
            OR lead(h) OVER w IS NULL OR lead(long) OVER w AS cut
  FROM marks WINDOW w AS (PARTITION BY row ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM cuts),
chunks AS (
  SELECT row, id, k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) > 1 OR bool_or(long) AS whole
  FROM numbered GROUP BY ALL),
judged AS (
  SELECT *, whole AND regexp_matches(chunk, '[^\x20\x09-\x0D]')
            AND row_number() OVER (PARTITION BY chunk, whole AND regexp_matches(chunk, '[^\x20\x09-\x0D]') ORDER BY id, k) > 1 AS gone
  FROM chunks),
placed AS (SELECT n.row, n.id, n.i, n.line, j.gone FROM numbered n JOIN judged j ON j.row = n.row AND j.k = n.k),
paired AS (SELECT *, line || chr(10) || lead(line) OVER (PARTITION BY row ORDER BY i) AS pair FROM placed),
again AS (
  SELECT *, pair IS NOT NULL AND row_number() OVER (PARTITION BY pair ORDER BY id, row, i) > 1 AS later FROM paired),
touched AS (
  SELECT *, coalesce(lag(later) OVER (PARTITION BY row ORDER BY i), false) AS before FROM again),
runs AS (
  SELECT *, sum((NOT before)::INT) OVER (PARTITION BY row ORDER BY i) AS run FROM touched),
weighed AS (
  SELECT *, (later OR before)
            AND (bool_or(gone) OVER (PARTITION BY row, run)
                 OR sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY row, run) >= 50) AS passage
  FROM runs),
left_over AS (
  SELECT row, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone AND NOT passage) AS kept FROM weighed GROUP BY row)
SELECT d.doc_id, coalesce(n_chunks, 0)::BIGINT AS n_chunks, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM (SELECT *, row_number() OVER () AS row FROM (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)
      UNION ALL SELECT doc_id, text, NULL FROM documents WHERE text IS NULL) d
LEFT JOIN (SELECT row, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed FROM judged GROUP BY row) j ON j.row = d.row
LEFT JOIN left_over o ON o.row = d.row
""",
    "op6_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS shuffled,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighted AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][rank % 3 + 1] AS weight FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / sum(weight) OVER (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, rank,
         least(3.0 * source_size, coalesce((SELECT level FROM levels WHERE level <= 3 * source_size / weight
                                            ORDER BY 3 * source_size / weight, rank LIMIT 1) * weight, 3 * source_size))::DOUBLE AS target
  FROM levels),
queue AS (
  SELECT s.doc_id, s.source, s.shuffled, s.size, t.source_size, t.rank, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffled, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, (epoch * source_size + upto)::DOUBLE / target AS finish
  FROM queue, range(3) AS e(epoch) WHERE size > 0 AND target > 0),
ordered AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rank, shuffled, doc_id NULLS FIRST, size, epoch ROWS UNBOUNDED PRECEDING) AS total
  FROM passes),
mix AS (
  SELECT doc_id, sum(size) AS taken FROM ordered WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(m.taken, 0)::BIGINT AS taken
FROM queue q LEFT JOIN mix m ON q.doc_id = m.doc_id
""",
    "op10_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
WINDOW w AS (PARTITION BY t)
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS key
  FROM conversations),
coded AS (
  -- crc32, bit by bit
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(octet_length(key)),
              lambda i: list_transform(range(8), lambda b: (('0x' || substr(hex(key), (2 * i + 1)::INT, 2))::BIGINT >> b::INT) & 1)))),
            lambda crc, bit: CASE WHEN (xor(crc, bit) & 1) = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END), 4294967295) % 20 AS code
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE code <> 0),
rows AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS empty,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS unended
  FROM damaged),
faults AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN empty THEN 'blank' WHEN again THEN 'duplicate' WHEN unended THEN 'truncated' ELSE '' END AS fault
  FROM rows),
-- cheapest way into each state, after each row; states: - nothing, s, u, a put out last
moves(state, ins, upto) AS (
  VALUES ('-', '', '-'), ('-', 'I', 'u'), ('-', 'II', 'a'), ('s', '', 's'), ('s', 'I', 'u'), ('s', 'II', 'a'),
         ('u', '', 'u'), ('u', 'I', 'a'), ('a', '', 'a'), ('a', 'I', 'u')),
edits(upto, letter, initial, state, cost) AS (
  SELECT upto, 'D', '', upto, 2 FROM (VALUES ('-'), ('s'), ('u'), ('a')) AS t(upto)
  UNION ALL SELECT * FROM (VALUES ('-', 'R', '', 'u', 1), ('s', 'R', '', 'u', 1), ('u', 'R', '', 'a', 1), ('a', 'R', '', 'u', 1),
    ('-', 'K', 's', 's', 0), ('-', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0), ('a', 'K', 'u', 'u', 0)) AS t(upto, letter, initial, state, cost)),
steps AS (
  SELECT m.state AS before, e.state AS after, e.letter, e.initial, m.ins || e.letter AS audit, 5 * length(m.ins) + e.cost AS cost
  FROM moves m JOIN edits e ON m.upto = e.upto),
ways AS (
  SELECT conv_id, 0::BIGINT AS pos, '-' AS state, 0::BIGINT AS cost, '' AS audit
  FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, pos, state, best.cost, best.audit FROM (
    SELECT w.conv_id, w.pos + 1 AS pos, s.after AS state,
           min(struct_pack(cost := w.cost + s.cost + CASE WHEN s.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
                           audit := w.audit || s.audit)) AS best
    FROM ways w
    JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1
    JOIN steps s ON s.before = w.state AND (s.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
                AND (s.initial = '' OR s.initial = f.initial)
    GROUP BY w.conv_id, w.pos, s.after)),
ends AS (
  SELECT conv_id, min(struct_pack(cost := cost + 5 * length(closing), audit := audit || closing)) AS best
  FROM (SELECT w.*, CASE state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS closing,
               max(pos) OVER (PARTITION BY conv_id) AS last FROM ways w)
  WHERE pos = last GROUP BY conv_id),
letters AS (
  -- one letter and the row it is for; inserted rows come before theirs
  SELECT conv_id, i, substr(best.audit, i::INT, 1) AS letter,
         length(replace(substr(best.audit, 1, i::INT - 1), 'I', '')) + 1 AS pos,
         best.audit AS audit
  FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS i FROM ends)),
kept AS (
  SELECT l.conv_id, l.i, CASE WHEN l.letter = 'K' THEN f.role END AS role, CASE WHEN l.letter = 'I' THEN '' ELSE f.text END AS text,
         l.letter = 'K' AND f.initial = 's' AS system,
         row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) AS place
  FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos
  WHERE l.letter <> 'D'),
placed AS (
  SELECT *, place - max(CASE WHEN system THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS number FROM kept),
texts AS (
  SELECT conv_id, string_agg(coalesce(role, CASE WHEN number % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY i) AS whole
  FROM placed GROUP BY conv_id),
neighbours AS (
  SELECT conv_id, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS last, pos, turn, fault FROM faults),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pos > 1 AND (last || initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM neighbours GROUP BY conv_id)
SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate,
       coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal,
       coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit, sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
""",
}
