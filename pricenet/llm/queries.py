"""Registered queries of the training-data operators, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, chat, chat_repair, embed_dedup, fingerprint, html_extract, licenses, minhash_forest, mixing, quality, secret_scan,
    tandem_runs, token_count)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op12_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tandem_runs.run_digests(tandem_runs.find_runs(table(spark, sf_dir, "documents"), plant=True))


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_chats(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_compression_quality, op2_license_scan, op3_minhash_forest, op4_source_mix, op5_chat_format, op6_embedding_tiles,
        op7_main_text, op8_token_counts, op9_fingerprints, op10_bpe, op11_secret_scan, op12_tandem_runs,
        op13_chat_repair)}

ORACLES: dict[str, str] = {}

# The mix: the clamped level of each source, then the seeded order of its documents.
ORACLES["op4_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM sources),
weighted AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CAST(source_size * 2 AS DOUBLE) AS cap FROM ranked),
totals AS (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5::DOUBLE AS total, sum(weight) AS all_weight FROM weighted),
levels AS (
  SELECT w.*, (t.total - coalesce(sum(cap) OVER before, 0)) / (t.all_weight - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted w, totals t
  WINDOW before AS (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT level FROM levels WHERE weight * level < cap ORDER BY cap / weight, rk LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * level < cap THEN weight * (SELECT level FROM final) ELSE cap END AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole_reps,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(whole_reps * size + greatest(0, least(size, round(target - whole_reps * source_size) - earlier)) AS BIGINT) AS taken,
       whole_reps,
       CAST(greatest(0, least(size, round(target - whole_reps * source_size) - earlier)) AS BIGINT) AS extra_words,
       source
FROM placed"""

# Chats: prefixes as whole strings instead of hashes.
ORACLES["op5_chat_format"] = r"""
WITH own AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM own),
grown AS (
  SELECT conv_id, pos, n,
         string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '')
           OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS text
  FROM placed),
whole AS (SELECT text, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM grown WHERE pos = n GROUP BY text, n),
shorter AS (SELECT DISTINCT text, pos FROM grown WHERE pos < n)
SELECT w.conv_id, w.n AS n_turns, w.n_copies, CAST(length(w.text) AS BIGINT) AS n_chars, w.text
FROM whole w LEFT JOIN shorter s ON s.text = w.text AND s.pos = w.n WHERE s.pos IS NULL"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, with the table ``crc_table.t`` (see CRC_TABLE) in scope."""
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))),"
            " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


CRC_TABLE = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                              lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i)))"""


def _grown(way: str, cost: str, letter: str) -> str:
    """A way is its cost in nine digits and its audit, so that ways compare as strings; null: no way."""
    return f"lpad(CAST(CAST(left({way}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({way}, 10) || '{letter}'"


# Periodic runs: equal words of every distance, joined to stretches.
ORACLES["op12_tandem_runs"] = rf"""
WITH {CRC_TABLE},
split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_table),
sized AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS harmed, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS g8 FROM split),
words AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN harmed AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g8)) ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM sized)),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, min(i) AS s, count(*) + q AS l, q FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l),
lists AS (
  SELECT doc_id, count(*) AS n_runs, first(struct_pack(s := s, l := l, q := q) ORDER BY l DESC, s, q) AS best,
         string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
collapsed AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
       CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN lists USING (doc_id) LEFT JOIN collapsed c USING (doc_id)"""

# Chat repair: the four states of the role automaton, row by row.
ORACLES["op13_chat_repair"] = rf"""
WITH RECURSIVE {CRC_TABLE},
own AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm
  FROM conversations, crc_table),
harmed AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM own WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) AS last
  FROM harmed),
judged AS (
  SELECT *, CASE WHEN last = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
                 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, CAST('000000000' AS VARCHAR) AS e, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a
  FROM facts
  UNION ALL
  SELECT conv_id, pos, {_grown("e", "4", "D")},
         CASE WHEN r = 's' AND fault NOT IN (1, 2) THEN least({_grown("s", "4", "D")}, {_grown("e", "late", "K")}) ELSE {_grown("s", "4", "D")} END,
         CASE WHEN fault IN (1, 2) THEN {_grown("u", "4", "D")}
              WHEN r = 'u' THEN least({_grown("u", "4", "D")}, {_grown("least(e, s, a)", "late", "K")})
              ELSE least({_grown("u", "4", "D")}, {_grown("least(e, s, a)", "late + 3", "R")}) END,
         CASE WHEN fault IN (1, 2) THEN {_grown("a", "4", "D")}
              WHEN r = 'a' THEN least({_grown("a", "4", "D")}, {_grown("u", "late", "K")})
              ELSE least({_grown("a", "4", "D")}, {_grown("u", "late + 3", "R")}) END
  FROM (SELECT conv_id, pos, r, fault, late, e, s, u, least(a, {_grown("u", "3", "I")}) AS a
        FROM (SELECT j.conv_id, j.pos, j.r, j.fault, CASE WHEN j.fault = 3 THEN 3 ELSE 0 END AS late, w.e, w.s, w.a,
                     least(w.u, {_grown("least(w.e, w.s, w.a)", "3", "I")}) AS u
              FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos + 1))),
best AS (
  SELECT f.conv_id, least(w.e, w.a, {_grown("least(w.u, " + _grown("least(w.e, w.s, w.a)", "3", "I") + ")", "3", "I")}) AS way
  FROM facts f JOIN walk w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = f.n),
letters AS (
  SELECT conv_id, unnest(string_split(substr(way, 10), '')) AS letter, generate_subscripts(string_split(substr(way, 10), ''), 1) AS i FROM best),
counted AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER sofar AS pos, count(*) FILTER (letter <> 'D') OVER sofar AS o,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd
  FROM letters WINDOW sofar AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
repaired AS (
  SELECT c.conv_id,
         string_agg(CASE WHEN letter = 'K' THEN j.role WHEN (o - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
                    || ':' || CASE WHEN letter = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY i) AS text
  FROM counted c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.pos = c.pos
  WHERE letter <> 'D' GROUP BY c.conv_id)
SELECT o.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(f.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(f.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(f.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(f.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(left(b.way, 9) AS BIGINT), 0) AS BIGINT) AS cost,
       coalesce(substr(b.way, 10), '') AS audit, sha256(coalesce(p.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id"""
