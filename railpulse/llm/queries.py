"""The registered queries of the operators, with production parameters over
whole tables, and the oracle SQL where DuckDB can express the result."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from railpulse.llm import byte_bpe, collocations, ctw, lexical, licenses, mixing, quality, sentencepiece_viterbi, simhash, substring, topk, toxicity, winnowing
from railpulse.llm.common import fold, table


def op1_ctw(spark: SparkSession, sf: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf, "documents"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rows = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return rows.select("doc_id", (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_tokens", "passages")


def op5_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return winnowing.compare_with_next(table(spark, sf, "documents"))


def op6_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


def op7_substring(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeated(table(spark, sf, "documents"))


def op8_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf, "documents")))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    encoded = sentencepiece_viterbi.encode_documents(table(spark, sf, "documents"))
    back = sentencepiece_viterbi.decode_documents(encoded)
    return back.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "tokens",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@F.arrow_udf(T.StringType())
def _ids_sha256(tokens: pa.Array) -> pa.Array:
    """Of the ids as little-endian unsigned 32-bit integers."""
    ids = tokens.flatten().to_numpy().astype("<u4")
    ends = np.cumsum(byte_bpe.list_sizes(tokens))
    return pa.array([hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())], pa.string())


def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = byte_bpe.load()
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(table(spark, sf, "documents"), vocabulary), vocabulary)
    return back.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), _ids_sha256("tokens").alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_lexical(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents")).drop("first_doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ctw": op1_ctw,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_winnowing": op5_winnowing,
    "op6_topk": op6_topk,
    "op7_substring": op7_substring,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_lexical": op11_lexical,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op6_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM r)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM k WHERE n <= 20
""",
    "op3_mixing": """
WITH d AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, sum(2 * source_size) OVER o - 2 * source_size AS capped, sum(w) OVER () - sum(w) OVER o + w AS rest,
         sum(source_size) OVER () AS total
  FROM s WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, w * max((1.5::DOUBLE * total - capped) / rest) OVER ()) AS target,
         ('0x' || substr(md5('offset 7:' || coalesce(source, chr(0))), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u
  FROM r),
k AS (
  SELECT d.doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
         row_number() OVER (PARTITION BY d.source ORDER BY size, md5('7:' || coalesce(doc_id::VARCHAR, '')), text) AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(i * e + u) - floor((i - 1) * e + u)))::BIGINT AS taken FROM k
""",
    "op11_lexical": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM benchmark WHERE text IS NOT NULL),
l AS (SELECT row_number() OVER () AS row, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM l),
v AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM l) GROUP BY ALL),
q AS MATERIALIZED (SELECT item, item_id, term, count(*) AS q FROM (SELECT item, item_id, unnest(ts) AS term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM v, s GROUP BY term, n_docs),
m AS (SELECT row, doc_id, 100 - 25 + (25 * n * n_docs) // total AS m FROM l, s),
r AS (
  SELECT item, item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN v USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item, item_id, doc_id, row),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS n FROM r WHERE score > 0)
SELECT item_id, n::INTEGER AS rank, doc_id, score FROM k WHERE n <= 20
""",
    "op13_collocations": """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS MATERIALIZED (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
x AS MATERIALIZED (SELECT id, lang, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w),
g AS MATERIALIZED (
  SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM x WINDOW o AS (PARTITION BY id ORDER BY i)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
k AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM f1) y USING (lang, w2)
  UNION ALL
  SELECT lang, concat_ws(' ', w1, w2, w3), f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM f2) y USING (lang, w2, w3)
  UNION ALL
  SELECT lang, concat_ws(' ', w1, w2, w3), f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM f1) y USING (lang, w3)),
s AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM k
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY ALL),
q AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM s LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase WHERE o.f IS NULL OR 100 * o.f < 50 * s.a),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang)
SELECT q.lang, rank, phrase, a, l, r, n, score FROM q JOIN t USING (lang) WHERE rank <= 2000
""",
}
