"""The registered queries of this package: thin projections of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import bpe, cotrain, decontaminate, embed_dedup, lm, nearest, prefix_trie, resample, secrets, simhash, substring_dedup, token_output, toxicity
from scorelake.llm.common import scratch_dir, table, tokenizer_path


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_output.read_documents(spark, path)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def crc32_of_bytes_sql(byte_list: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a list of byte values: the reflected polynomial, bit by bit."""
    step = "list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce({byte_list}, lambda acc, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def crc32_sql(expr: str) -> str:
    """DuckDB SQL for the unsigned crc32 of ``expr`` as decimal text (ASCII only)."""
    return crc32_of_bytes_sql(f"list_transform(split(CAST({expr} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))")


def utf8_bytes_sql(expr: str) -> str:
    """DuckDB SQL for the UTF-8 bytes of a text as a list of numbers."""
    return (f"list_transform(range(0, octet_length(encode({expr}))), "
            f"lambda i: CAST('0x' || substr(hex(encode({expr})), 2 * i + 1, 2) AS BIGINT))")


#: Nodes as lists of turns, subtrees by list prefixes: a plain statement of the contract, quadratic in the nodes.
OP11_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS b, {crc32_sql('c')} % 4 AS h FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
pre AS (SELECT i.c, t.pos, t.role, t.text FROM ids i JOIN t ON t.c = i.b AND t.pos < i.h),
taken AS (SELECT c, count(*) AS m FROM pre GROUP BY c),
own AS (SELECT i.c, coalesce(taken.m, 0) + t.pos - i.h AS pos, t.role, t.text
        FROM ids i JOIN t ON t.c = i.c AND t.pos >= i.h LEFT JOIN taken ON taken.c = i.c),
r AS (SELECT * FROM pre UNION ALL SELECT * FROM own),
seqs AS (SELECT i.c, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS turns
         FROM ids i LEFT JOIN r ON r.c = i.c GROUP BY i.c),
mem AS (SELECT c, d, list_slice(turns, 1, d) AS p, len(turns) AS n FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM seqs)),
node AS (SELECT p, min(c) AS conv_id, min(d) AS depth, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256
         FROM mem GROUP BY p),
nd AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS words,
              CASE WHEN depth = 0 THEN NULL ELSE list_slice(p, 1, depth - 1) END AS pp FROM node),
kids AS (SELECT pp, count(*) AS k FROM nd WHERE pp IS NOT NULL GROUP BY pp),
nk AS (SELECT nd.*, coalesce(kids.k, 0) AS n_children FROM nd LEFT JOIN kids ON kids.pp = nd.p),
sub AS (SELECT v.p, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
        FROM nk v JOIN nk u ON u.depth >= v.depth AND list_slice(u.p, 1, v.depth) = v.p GROUP BY v.p)
SELECT nk.conv_id, CAST(nk.depth AS BIGINT) AS depth, par.conv_id AS parent_conv_id, CAST(nk.n_convs AS BIGINT) AS n_convs,
       CAST(nk.n_children AS BIGINT) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens,
       nk.ends_sha256
FROM nk JOIN sub ON sub.p = nk.p LEFT JOIN nk par ON par.p = nk.pp
"""


def op12_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs by exact cosine and components by a recursive walk: the plain statement, quadratic in the rows.
OP12_SQL = """
WITH RECURSIVE e0 AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT rid, vec_id, list_transform(v, lambda x: coalesce(x, 0.0)) AS v FROM e0
       WHERE vec_id IS NOT NULL AND v IS NOT NULL AND len(v) > 0
         AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x)))
         AND list_bool_or(list_transform(v, lambda x: x <> 0))),
pairs AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.rid <> b.rid
          WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95),
reach(src, dst) AS (SELECT rid, rid FROM ok UNION SELECT reach.src, pairs.b FROM reach JOIN pairs ON pairs.a = reach.dst),
comp AS (SELECT reach.src AS rid, min(ok.vec_id) AS component_id FROM reach JOIN ok ON ok.rid = reach.dst GROUP BY reach.src),
links AS (SELECT a AS rid, count(*) AS n FROM pairs GROUP BY a)
SELECT e0.vec_id, CAST(coalesce(links.n, 0) AS BIGINT) AS n_links,
       CAST(CASE WHEN ok.rid IS NULL THEN e0.vec_id ELSE comp.component_id END AS BIGINT) AS component_id,
       e0.vec_id = CASE WHEN ok.rid IS NULL THEN e0.vec_id ELSE comp.component_id END AS kept
FROM e0 LEFT JOIN ok ON ok.rid = e0.rid LEFT JOIN comp ON comp.rid = e0.rid LEFT JOIN links ON links.rid = e0.rid
"""


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS13 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Words by the regular expression, crc32 of their UTF-8 bytes bit by bit, gains and ranks as the contract states them.
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS13} AS w FROM documents),
occ AS (SELECT rid, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_WORDS13}) AS word FROM benchmark),
dist AS (SELECT DISTINCT word FROM (SELECT word FROM occ UNION ALL SELECT word FROM bw)),
crc AS (SELECT word, {crc32_of_bytes_sql(utf8_bytes_sql('word'))} % 10000 AS bucket FROM dist),
s AS (SELECT bucket, count(*) AS n FROM occ JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN crc USING (word) GROUP BY bucket),
tot AS (SELECT CAST((SELECT count(*) FROM occ) AS DOUBLE) AS s_all, CAST((SELECT count(*) FROM bw) AS DOUBLE) AS t_all),
g AS (SELECT b.bucket, floor(1000.0 * ln((coalesce(t.n, 0) + 1.0) * (tot.s_all + 10000) / ((coalesce(s.n, 0) + 1.0) * (tot.t_all + 10000)))) AS gain
      FROM (SELECT DISTINCT bucket FROM crc) b CROSS JOIN tot LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
per AS (SELECT occ.rid, sum(g.gain) AS total FROM occ JOIN crc USING (word) JOIN g USING (bucket) GROUP BY occ.rid),
w AS (SELECT d.rid, d.doc_id, len(d.w) AS n_features,
             CAST(CASE WHEN len(d.w) = 0 THEN 0 ELSE floor(per.total / len(d.w)) END AS BIGINT) AS weight
      FROM d LEFT JOIN per ON per.rid = d.rid),
sc AS (SELECT *, weight + CAST(floor(-1000.0 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8)) AS UBIGINT) + 0.5)
                                                     / 4294967296.0))) AS BIGINT) AS score FROM w),
el AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS r FROM sc WHERE n_features >= 20 AND doc_id IS NOT NULL),
k AS (SELECT count(*) * 10 // 100 AS draw FROM el)
SELECT sc.doc_id, CAST(sc.n_features AS BIGINT) AS n_features, sc.weight, sc.score,
       CAST(CASE WHEN el.r <= k.draw THEN el.r END AS BIGINT) AS rank
FROM sc LEFT JOIN el ON el.rid = sc.rid CROSS JOIN k
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_lm_scoring, op2_substring_dedup, op3_token_output, op4_decontaminate, op5_toxicity, op6_bpe, op7_nearest, op8_secrets, op9_quality, op10_simhash,
        op11_prefix_trie, op12_embed_dedup, op13_resample)}
ORACLES: dict[str, str] = {"op11_prefix_trie": OP11_SQL, "op12_embed_dedup": OP12_SQL, "op13_resample": OP13_SQL}
