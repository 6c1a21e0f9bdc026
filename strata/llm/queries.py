"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from strata.llm.common import table
from strata.llm.exact_dedup import exact_groups
from strata.llm.license_scan import license_scan
from strata.llm.mixing import mixed
from strata.llm.packing import packed, piece_digests
from strata.llm.prefix_trie import prefix_trie
from strata.llm.private_data import personal_data
from strata.llm.quality import quality
from strata.llm.resampling import resampled
from strata.llm.simhash import near_groups
from strata.llm.suffix_family import repeats
from strata.llm.token_counts import token_counts
from strata.llm.topk import top_k
from strata.llm.toxicity import toxicity


def op4_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op2_personal_data(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op3_pack_curve(spark, sf_dir):
    return piece_digests(packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def op5_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"))


def op7_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op8_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents")).drop("source")


def op10_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_suffix_dedup(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_resample(spark, sf_dir):
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_personal_data,
        op3_pack_curve,
        op4_exact_dedup,
        op5_quality,
        op6_simhash,
        op7_top_k,
        op8_license_scan,
        op9_mix_sources,
        op10_toxicity,
        op11_suffix_dedup,
        op12_prefix_trie,
        op13_resample,
    )
}

#: CRC-32 of a blob's bytes, each as two hex digits, with the table computed from the polynomial.
CRC32 = """
        crc_table AS MATERIALIZED (
          SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), crc AS MATERIALIZED (
          SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex(encode(w))), 2),
            lambda i: CAST('0x' || substr(hex(encode(w)), CAST(i AS BIGINT) + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
          FROM (SELECT DISTINCT w FROM crc_of), crc_table
        )"""

ORACLES = {
    "op12_prefix_trie": """
        WITH crc_of AS (SELECT CAST(conv_id AS VARCHAR) AS w FROM conversations WHERE conv_id IS NOT NULL
        ), {crc}, o AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
            {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (SELECT conv_id, list(x ORDER BY k) AS xs FROM o GROUP BY conv_id
        ), r AS (
          SELECT a.conv_id, list_concat(coalesce(b.xs[1:h % 6], []), a.xs[h % 6 + 1:]) AS xs
          FROM own a JOIN crc ON w = CAST(a.conv_id AS VARCHAR) LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
        ), q AS (SELECT conv_id, depth, len(xs) = depth AS ends, xs[1:depth] AS path FROM (SELECT conv_id, xs, unnest(range(0, len(xs) + 1)) AS depth FROM r)
        ), n AS (
          SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
          FROM q GROUP BY depth, path
        ), kids AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
        ), v AS (
          SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(n.path[n.depth].text) ELSE 0 END AS saved
          FROM n LEFT JOIN kids USING (depth, path)
        ), sub AS (
          SELECT q.depth, q.path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
          FROM v JOIN q ON q.conv_id = v.conv_id AND q.depth <= v.depth GROUP BY q.depth, q.path
        )
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
          CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ids, '')) AS ends_sha256
        FROM v JOIN sub USING (depth, path) LEFT JOIN n p ON p.depth = v.depth - 1 AND p.path = v.path[1:v.depth - 1]""".replace("{crc}", CRC32.strip()),
    "op13_resample": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), b AS (
          SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
        ), u AS MATERIALIZED (SELECT r, unnest(words) AS w FROM d
        ), crc_of AS (SELECT w FROM u UNION SELECT w FROM b
        ), {crc}, x AS (SELECT w, h % 10000 AS k FROM crc
        ), s AS (SELECT k, count(*) AS n FROM u JOIN x USING (w) GROUP BY k
        ), t AS (SELECT k, count(*) AS n FROM b JOIN x USING (w) GROUP BY k
        ), g AS (
          SELECT k, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
            / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS BIGINT) AS gain
          FROM s FULL JOIN t USING (k)
        ), weights AS (SELECT r, sum(gain) AS weight FROM u JOIN x USING (w) JOIN g USING (k) GROUP BY r
        ), scored AS (
          SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
              + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
          FROM d LEFT JOIN weights USING (r)
        ), ranked AS (
          SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS k, count(*) OVER () AS n
          FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * n // 100 THEN k END AS rank
        FROM scored LEFT JOIN ranked USING (r)""".replace("{crc}", CRC32.strip()).replace("\\\\", "\\"),
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
          doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
    "op7_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
        ), r AS (
          SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT * FROM r WHERE rank <= 5""",
    "op9_mix_sources": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, coalesce('0' || source, '1') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, lang, n_chars FROM documents
        ), s AS (
          SELECT src, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY src) - 1) % 3] AS w FROM d GROUP BY src
        ), rounds AS (
          SELECT 0 AS n, src, source_size, w, 0::BIGINT AS cap, false AS capped, (SELECT sum(source_size) FROM s)::BIGINT AS rest, (SELECT sum(w) FROM s)::BIGINT AS ws FROM s
          UNION ALL
          SELECT n + 1, src, source_size, w, cap, capped, (total - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::BIGINT,
            sum(CASE WHEN capped THEN 0 ELSE w END) OVER ()::BIGINT
          FROM (SELECT n, src, source_size, w, cap, capped OR rest * w > 3 * source_size * ws AS capped, (SELECT sum(source_size) FROM s) AS total FROM rounds WHERE n < 60)
        ), t AS (
          SELECT src, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE (rest * w)::DOUBLE / ws END AS target FROM rounds WHERE n = 60
        ), p AS (
          SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS b,
            (sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, lang, n_chars ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
          FROM d JOIN t USING (src)
        )
        SELECT doc_id, size, source_size, target,
          (CASE WHEN source_size = 0 THEN 0 ELSE (b // source_size) * size + greatest(0, least(size, b % source_size - before)) END)::BIGINT AS taken
        FROM p""",
}
