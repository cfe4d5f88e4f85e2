"""The registered queries: each operator over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, fill_middle, langid, mixing, neighbours, packing, private, quality, repeats, simhash, token_counts, toxicity, vector_codes
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.cut_repeats(table(spark, sf_dir, "documents")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.digests(private.find_private(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_quality, op2_token_counts, op3_packing, op4_repeats, op5_language, op6_exact_dedup,
                                   op7_toxicity, op8_mix_sources, op9_simhash, op10_neighbours, op11_private, op12_vector_codes, op13_fill_middle)}


def _codes_sql(rounds: int = 2) -> str:
    """Rounds of assignment and integer means, all distances written out; b<i> are codebooks."""
    near = """a{i} AS (SELECT part, r, any_value(x) AS x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * 64 + entry) AS best
        FROM p JOIN b{i} USING (part) GROUP BY part, r)"""
    mean = """u{i} AS (SELECT part, best % 64 AS entry, unnest(x) AS v, unnest(range(len(x))) AS place FROM a{j}),
        s{i} AS (SELECT part, entry, place, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS v FROM u{i} GROUP BY ALL),
        m{i} AS (SELECT part, entry, list(v::BIGINT ORDER BY place) AS c FROM s{i} GROUP BY ALL),
        b{i} AS (SELECT part, entry, coalesce(m{i}.c, b{j}.c) AS c FROM b{j} LEFT JOIN m{i} USING (part, entry))"""
    steps = ", ".join(near.format(i=i) + ", " + mean.format(i=i + 1, j=i) for i in range(rounds))
    return f"""
        WITH n AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT r, q.part, list_slice(v, q.part * (len(v) // 16) + 1, (q.part + 1) * (len(v) // 16)) AS x FROM n, (SELECT unnest(range(16)) AS part) q),
        b0 AS (SELECT part, r AS entry, x AS c FROM p WHERE r < 64), {steps}, {near.format(i=rounds)},
        e AS (SELECT r, string_agg(printf('%02x', (best % 64)::BIGINT), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a{rounds} GROUP BY r),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM n JOIN e USING (r), h"""

SQL = {
    "op6_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g ON n.t = g.t""",
    "op12_vector_codes": _codes_sql(),
    "op13_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        e AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
            ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
        f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                 WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
        g AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, z - a) AS m, substr(t, z + 1) AS s FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256 FROM g""",
}
