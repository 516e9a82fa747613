"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import shipped, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def id_rest(mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id has none."""
    return F.crc32(F.col("doc_id").cast("string")) % mod


@query("op5_line_dedup", """
WITH lines AS (
  SELECT rowid_ AS r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid_, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (SELECT keyed.*, often.k IS NOT NULL AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r, doc_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.line_dedup import drop_frequent_lines
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs, min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.common import written
    from tidegrid.llm.simhash import fingerprints, hex_print, near_groups
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = written(fingerprints(docs, shingle=3).select("doc_id", "fingerprint"), "simhash")
    return near_groups(printed, max_bits=3).select(
        "doc_id", hex_print().alias("fingerprint"), "component_id")


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.quality import compression_bands
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_bands(docs).drop("text")


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.toxicity import toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(id_rest(5) != 0)
    return toxicity(docs, labels).select(
        "doc_id", F.coalesce(id_rest(5) == 0, F.lit(False)).alias("held_out"), "score",
        "predicted")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"))


@query("op10_ppm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.ppm import ppm_scores
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(id_rest(7) == 2, F.lit(False))
    scored = ppm_scores(docs.withColumn("held_out", held), "NOT held_out")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query("op2_sentence_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.sentence_pieces import encoding_facts
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoding_facts(docs).select(
        "doc_id", "n_ids", "n_byte_ids", "ids_crc32", F.sha2("decoded", 256)
        .alias("decoded_sha256"), "round_trip")


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.language import fit, predict
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, id_rest(4) != 2)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(id_rest(4) == 2, F.lit(False)).alias("held_out"), "lang_pred",
        "score")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.html_text import main_text
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", "n_chars")


@query("op4_mtree", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored) WHERE rank <= 5
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.mtree import top_k
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.periods import periodic_runs
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs(docs, key="doc_id").drop("text")


@query("op12_decontamination", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS g FROM (
    SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w]
                           ELSE list_transform(range(1, len(w) - 8), lambda k: w[k:k+9]) END) AS x
    FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT r, n, k, array_to_string(w[k:k+n-1], ' ') AS g FROM (
    SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, n, k, g FROM grams WHERE g IN (SELECT g FROM win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit)
          GROUP BY r),
ids AS (SELECT r, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM hit JOIN win USING (g) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.postings import decontaminate
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark").select("item_id", "text"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query("op11_conversation_repair", r"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k
  FROM conversations),
kinds AS (
  SELECT keyed.*, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos,
         left(role, 1) AS ini
  FROM damaged),
faulty AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv ORDER BY pos) AS back,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated'
              ELSE '' END AS fault
  FROM placed),
facts AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pos > 1 AND concat(back, ini) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv),
-- states: 0 nothing, 1 system, 2 user, 3 assistant; insertions from one state to another
inserts(s, ins, t, lines) AS (VALUES
  (0, '', 0, ''), (1, '', 1, ''), (2, '', 2, ''), (3, '', 3, ''),
  (0, 'I', 2, chr(10) || 'user:'), (1, 'I', 2, chr(10) || 'user:'), (3, 'I', 2, chr(10) || 'user:'),
  (2, 'I', 3, chr(10) || 'assistant:'),
  (0, 'II', 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 'II', 3, chr(10) || 'user:' || chr(10) || 'assistant:')),
moves(op, cost, s, ini, t, as_role) AS (VALUES
  ('D', 3, 0, NULL, 0, NULL), ('D', 3, 1, NULL, 1, NULL), ('D', 3, 2, NULL, 2, NULL),
  ('D', 3, 3, NULL, 3, NULL), ('K', 0, 0, 's', 1, NULL), ('K', 0, 0, 'u', 2, NULL),
  ('K', 0, 1, 'u', 2, NULL), ('K', 0, 3, 'u', 2, NULL), ('K', 0, 2, 'a', 3, NULL),
  ('R', 2, 0, NULL, 2, 'user'), ('R', 2, 1, NULL, 2, 'user'), ('R', 2, 3, NULL, 2, 'user'),
  ('R', 2, 2, NULL, 3, 'assistant')),
edits(conv, pos, state, best) AS (
  SELECT conv, CAST(0 AS BIGINT), 0, {'c': CAST(0 AS BIGINT), 'a': '', 'o': ''} FROM facts
  UNION ALL
  SELECT e.conv, f.pos, m.t,
         min({'c': CAST(e.best.c + 2 * len(i.ins) + m.cost
                        + CASE WHEN m.op <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS BIGINT),
              'a': concat(e.best.a, i.ins, m.op),
              'o': concat(e.best.o, i.lines, CASE WHEN m.op = 'D' THEN '' ELSE
                          concat(chr(10), coalesce(m.as_role, f.role), ':', f.text) END)})
  FROM edits e JOIN faulty f ON f.conv IS NOT DISTINCT FROM e.conv AND f.pos = e.pos + 1
  JOIN inserts i ON i.s = e.state
  JOIN moves m ON m.s = i.t AND (m.ini IS NULL OR m.ini = f.ini)
       AND (m.op = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY e.conv, f.pos, m.t),
solved AS (
  SELECT e.conv, min({'c': CAST(e.best.c + 2 * len(i.ins) AS BIGINT), 'a': concat(e.best.a, i.ins),
                      'o': concat(e.best.o, i.lines)}) AS best
  FROM edits e JOIN facts f ON f.conv IS NOT DISTINCT FROM e.conv AND f.n = e.pos
  JOIN inserts i ON i.s = e.state WHERE i.t IN (0, 3) GROUP BY e.conv)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved s ON s.conv IS NOT DISTINCT FROM c.conv_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.llm.dialogues import repair
    return repair(table(spark, sf_dir, "conversations"), damage=True)
