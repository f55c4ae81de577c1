"""The operators bound to the driver tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, common, conversation_repair, exact_dedup, lang_id, merkle, mixing, piece_bpe,
               quality, sharding, simhash, suffix_dedup, toxicity, url_filter)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text_id_crc() -> Column:
    """CRC-32 of the doc_id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


# The rules the url query judges by.
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"), URL_RULES)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_text_id_crc() % 4 == 2, F.lit(False))
    model = lang_id.learn(docs.filter(~held_out))
    return lang_id.predict(docs, model).withColumn("held_out", held_out) \
        .select("doc_id", "held_out", "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(_read(spark, sf_dir, "documents")).drop("uid")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"), 40).drop("cell")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"), 50)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(mixing.by_source(_read(spark, sf_dir, "documents"))) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(_text_id_crc() % 5 == 0, F.lit(False))
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).withColumn("held_out", held_out) \
        .select("doc_id", "held_out", "score", "predicted")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, max_bits=3) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.encode(_read(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN,
                      ("n_tokens", "ids_sha256", "decoded_sha256"))


def _damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by their key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.withColumn("_kind", F.crc32(key.cast("binary")) % 20).filter("_kind != 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", ""))
         .otherwise(text).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
         .alias("_copy")).drop("_copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations")
    return conversation_repair.repair(_damaged(conversations), every=conversations)


# The letters that tampering changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(_text_id_crc() % 3 == 0, F.translate("text", UPPER, LOWER))
    return merkle.manifest(_read(spark, sf_dir, "documents"), tampered,
                           ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return piece_bpe.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                            ("n_tokens", "ids_sha256", "decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_language, op3_quality, op4_exact_dedup, op5_sharding, op6_suffix_dedup,
                                    op7_mixing, op8_toxicity, op9_simhash, op10_bpe, op11_repair,
                                    op12_manifest, op13_pieces)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": ORACLE_OP1, "op4_exact_dedup": ORACLE_OP4, "op6_suffix_dedup": ORACLE_OP6,
            "op12_manifest": ORACLE_OP12}


ORACLE_OP4 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

ORACLE_OP1 = r"""
WITH r(rule, host, path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM p),
u AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM q)
SELECT page_id, host, path,
       (SELECT arg_max(r.rule, length(r.rule)) FROM r
         WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.rule)) FROM r
         WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)),
         'allow') AS verdict
FROM u
"""

#: Kept pieces are joined as hexadecimal digits, two a byte.
ORACLE_OP6 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, hex(b) AS h, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, i, array_slice(b, i + 1, i + 50) AS s
      FROM (SELECT doc_id, b, unnest(range(0, greatest(n - 49, 0))) AS i FROM n)),
f AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
g AS (SELECT w.doc_id, i FROM w JOIN f USING (s) WHERE first_id < w.doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS e FROM
        (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM
           (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS fresh
            FROM g)) GROUP BY doc_id, run),
p AS (SELECT r.doc_id, a, e, substr(h, 2 * coalesce(lag(e) OVER (PARTITION BY r.doc_id ORDER BY a), 0) + 1,
                                    2 * (a - coalesce(lag(e) OVER (PARTITION BY r.doc_id ORDER BY a), 0))) AS before
      FROM r JOIN n USING (doc_id)),
k AS (SELECT doc_id, sum(e - a) AS removed, count(*) AS spans, max(e) AS last_end,
             string_agg(before, '' ORDER BY a) AS kept FROM p GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_end, 0) + 1))) AS kept_sha256
FROM n LEFT JOIN k USING (doc_id)
"""

#: crc32 is reckoned bit by bit; the trees and the folds are recursions.
ORACLE_OP12 = """
WITH RECURSIVE p AS (
  SELECT doc_id, lang, text, row_number() OVER () AS uid,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS lead,
         list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
             lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents),
l AS (
  SELECT uid, doc_id, lang, sha256(lead || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0
              THEN sha256(lead || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                                            'abcdefghijklmnopqrstuvwxyz'), '-')) END AS probe
  FROM p),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n FROM l),
t(lang, level, idx, n, hash) AS (
  SELECT lang, 0, i, n, leaf FROM o
  UNION ALL
  SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM t WHERE n > 1 GROUP BY lang, level, idx // 8, n),
s AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM t WHERE n = 1),
u(level, idx, n, hash) AS (
  SELECT 0, i, n, subroot FROM s
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM u WHERE n > 1 GROUP BY level, idx // 8, n),
tb AS (
  SELECT lang, level, idx, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM t WHERE n > 1 WINDOW w AS (PARTITION BY lang, level, idx // 8 ORDER BY idx)),
ub AS (
  SELECT level, idx, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM u WHERE n > 1 WINDOW w AS (PARTITION BY level, idx // 8 ORDER BY idx)),
f(uid, lang, level, idx, acc, proof) AS (
  SELECT uid, lang, 0, i, coalesce(probe, leaf), '' FROM o
  UNION ALL
  SELECT f.uid, f.lang, f.level + 1, f.idx // 8, sha256(b || acc || a), proof || b || a
  FROM f JOIN tb ON f.lang IS NOT DISTINCT FROM tb.lang AND f.level = tb.level AND f.idx = tb.idx),
e AS (SELECT uid, lang, arg_max(acc, level) AS acc, arg_max(proof, level) AS proof FROM f GROUP BY uid, lang),
g(uid, subroot, level, idx, acc, proof) AS (
  SELECT uid, subroot, 0, i, acc, proof FROM e JOIN s ON e.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT g.uid, subroot, g.level + 1, g.idx // 8, sha256(b || acc || a), proof || b || a
  FROM g JOIN ub ON g.level = ub.level AND g.idx = ub.idx),
k AS (SELECT uid, subroot, arg_max(acc, level) AS acc, arg_max(proof, level) AS proof FROM g GROUP BY uid, subroot)
SELECT doc_id, leaf, subroot, (SELECT hash FROM u WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
       acc AS folded_root, acc = (SELECT hash FROM u WHERE n = 1) AS verified
FROM l JOIN k USING (uid)
"""
