"""Registered queries of the operators, over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, codes, counting, fingerprints, language, licenses, mixing, packing, quality, sharding, similarity, substrings, toxicity
from .common import documents, labels


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.orderBy(F.col("position1").asc_nulls_last(), "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken",
        F.round("position1", 9).alias("position1"), F.round("position2", 9).alias("position2"))


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op3_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_with_edits(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_quality(docs, quality.learn_quality(docs, labels(spark, sf_dir)))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).withColumn("expressions", F.array_join("expressions", ";"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_toxicity(docs, toxicity.learn_lexicon(docs, labels(spark, sf_dir)))


def op8_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(documents(spark, sf_dir))


def op9_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), n_shards=24)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predict_language(docs, language.learn_languages(docs))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(documents(spark, sf_dir), labels(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, entries = codes.compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                        F.lit(codes.codebooks_sha256(entries)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_pack_documents, op3_edit_token_counts, op4_quality_rules, op5_license_scan,
                                   op6_ngram_jaccard, op7_toxicity, op8_lz_fingerprints, op9_ring_shards, op10_language_id,
                                   op11_substring_dedup, op12_filter_audit, op13_vector_codes)}


def _position_sql(x: str) -> str:
    """The inverse demand of ``mixing.SCHEDULES`` at the share ``x`` for the source's turn."""
    cases = []
    for i, knots in enumerate(mixing.SCHEDULES):
        step = 1.0 / (len(knots) - 1)
        area = sum((a + b) / 2 * step for a, b in zip(knots, knots[1:]))
        done, when = 0.0, []
        for k, (a, b) in enumerate(zip(knots, knots[1:])):
            a, b = a / area, b / area
            rest = f"greatest(0.0, {x} - {done!r})"
            at = f"{k * step!r} + least({step!r}, 2 * {rest} / ({a!r} + sqrt(greatest(0.0, {a * a!r} + {rest} * {2 * (b - a) / step!r}))))"
            done += (a + b) / 2 * step
            when.append(f"WHEN {x} < {done!r} THEN {at}")
        cases.append(f"WHEN turn % {len(mixing.SCHEDULES)} = {i} THEN CASE {' '.join(when)} ELSE 1.0 END")
    return f"CASE {' '.join(cases)} END"


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
t AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS turn FROM s),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][turn % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS most FROM t),
c AS (
  SELECT *, sum(source_size) OVER () AS all_words,
    coalesce(sum(most) OVER (ORDER BY most / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(weight) OVER (ORDER BY most / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM w),
l AS (SELECT *, (all_words * 1.5::DOUBLE - below) / above AS lev FROM c),
f AS (SELECT lev FROM l WHERE lev * weight <= most ORDER BY most / weight, turn LIMIT 1),
g AS (SELECT source, source_size, turn, least(most, coalesce((SELECT lev FROM f) * weight, most)) AS target FROM l),
k AS (SELECT *, ('0x' || substr(md5(concat_ws('-', doc_id::VARCHAR, size::VARCHAR)), 1, 15))::BIGINT AS key FROM d),
o AS (
  SELECT k.doc_id, k.size, g.source_size, g.target, g.turn, floor(g.target)::BIGINT AS whole,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, greatest(0, least(size, whole - c)) AS take1, greatest(0, least(size, whole - c - source_size)) AS take2 FROM o)
SELECT doc_id, size, source_size, target, (take1 + take2)::BIGINT AS taken,
  CASE WHEN take1 > 0 THEN round({_position_sql('(c / target)')}, 9) END AS position1,
  CASE WHEN take2 > 0 THEN round({_position_sql('((c + source_size) / target)')}, 9) END AS position2
FROM p
"""

OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, unnest(generate_series(1, len(w) - 12)) AS p, w FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL),
h AS (SELECT r, doc_id, p, array_to_string(w[p:p + 12], ' ') AS run FROM g),
f AS (SELECT run, min(doc_id) AS low FROM h GROUP BY run HAVING count(*) > 1),
c AS (SELECT h.r, h.p FROM h JOIN f ON f.run = h.run AND f.low < h.doc_id),
x AS (SELECT DISTINCT r, unnest(generate_series(p, p + 12)) AS p FROM c),
o AS (SELECT r, list(p) AS gone FROM x GROUP BY r),
k AS (SELECT d.doc_id, d.w, coalesce(o.gone, []) AS gone FROM d LEFT JOIN o ON o.r = d.r),
s AS (SELECT doc_id, w, len(gone) AS n, CASE WHEN len(gone) = 0 THEN w ELSE
        list_transform(list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept FROM k)
SELECT doc_id, len(w)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM s
"""

# Every document is walked through every order, filter by filter.
OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT t.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
    (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d,
    coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS e FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
fails AS (SELECT part, good, toxic, [a, b, c, d, e] AS f, a + b + c + d + e AS n_fails, count(*) AS n FROM d GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE b.x NOT IN (a.x) AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
o AS (SELECT filter_order, step, list_transform(string_split(filter_order, ''), lambda y: ascii(y) - 64) AS i
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT fails.*, filter_order, step, i[step] AS own, f[i[step]] AS failing,
    list_sum(list_transform(i[:step - 1], lambda j: f[j])) > 0 AS gone FROM fails, o),
m AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN failing = 0 AND NOT coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN failing = 1 AND NOT coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN failing = 1 AND coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failing = 1 AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN failing = 1 AND NOT coalesce(gone, false) THEN n * good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN failing = 1 AND NOT coalesce(gone, false) THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM m
"""


def _codes_sql() -> str:
    """Plain k-means: every part is compared with every entry in each round."""
    n, m = codes.PARTS, codes.ENTRIES
    ctes = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT r, part, v[part * len(v) // {n} + 1:(part + 1) * len(v) // {n}] AS x FROM v, (SELECT unnest(generate_series(0, {n - 1})) AS part))",
        f"e0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, v) - 1 AS entry, x AS c FROM x JOIN "
        f"(SELECT r, vec_id, v FROM v ORDER BY vec_id, v LIMIT {m}) USING (r))"]
    for k in range(codes.ROUNDS + 1):
        ctes.append(
            f"a{k} AS MATERIALIZED (SELECT r, part, x, w.entry, w.d FROM (SELECT r, x.part, x, min(struct_pack(d := list_sum(list_transform(generate_series(1, len(x)), "
            f"lambda i: (x[i] - c[i]) * (x[i] - c[i]))), entry := entry)) AS w FROM x JOIN e{k} ON e{k}.part = x.part GROUP BY ALL))")
        if k < codes.ROUNDS:
            ctes.append(f"s{k} AS (SELECT part, entry, i, floor_div FROM (SELECT part, entry, i, sum(x[i])::HUGEINT AS s, count(*) AS n, "
                        f"CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END::BIGINT AS floor_div FROM a{k}, (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM x))) AS i) GROUP BY part, entry, i))")
            ctes.append(f"e{k + 1} AS MATERIALIZED (SELECT e{k}.part, e{k}.entry, coalesce(u.c, e{k}.c) AS c FROM e{k} LEFT JOIN "
                        f"(SELECT part, entry, list(floor_div ORDER BY i) AS c FROM s{k} GROUP BY part, entry) u ON u.part = e{k}.part AND u.entry = e{k}.entry)")
    last = codes.ROUNDS
    ctes.append(f"o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY r)")
    ctes.append(f"b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{last})")
    return "WITH " + ",\n".join(ctes) + ("\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 "
                                         "FROM v JOIN o USING (r), b")


OP13_SQL = _codes_sql()

ORACLE_SQL = {"op1_mix_sources": OP1_SQL, "op11_substring_dedup": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": OP13_SQL}
