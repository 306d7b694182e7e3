"""Each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.common import table
from tidegate.llm import (
    bpe,
    codebooks,
    ctw,
    html,
    infill,
    langid,
    mixing,
    neardup,
    packing,
    simhash,
    substrings,
    topk,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed tokenizers package; files are not part of this library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.score_documents(spark, documents, labels)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), k=10, every=100)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(spark, table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark, table(spark, sf_dir, "pages"))


def op11_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_path("word_bpe_49k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return bpe.digests(bpe.decode(encoded, vocabulary))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress(spark, table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_simhash_near_dedup,
        op2_mixing,
        op3_toxicity,
        op4_language_id,
        op5_substring_dedup,
        op6_exact_top_k,
        op7_best_fit_packing,
        op8_embedding_near_dedup,
        op9_lm_scoring,
        op10_html_extraction,
        op11_bpe_encoding,
        op12_vector_codes,
        op13_fill_in_middle,
    )
}

def _round_sql(number: int) -> str:
    """The codebooks after a round, from those before it."""
    return f"""
near{number} AS (
    SELECT n, part, arg_min(entry, (gap, entry)) AS entry
    FROM (
        SELECT p.n, p.part, c.entry,
               list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS gap
        FROM parts p JOIN book{number - 1} c ON p.part = c.part
    ) GROUP BY n, part
),
mean{number} AS (
    SELECT s.part, s.entry, list(s.m ORDER BY s.spot) AS v
    FROM (
        SELECT part, entry, spot, CAST(floor(sum(x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS m
        FROM (
            SELECT p.part, r.entry, unnest(p.v) AS x, unnest(range(len(p.v))) AS spot
            FROM parts p JOIN near{number} r ON p.n = r.n AND p.part = r.part
        ) GROUP BY part, entry, spot
    ) s GROUP BY s.part, s.entry
),
book{number} AS (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
    FROM book{number - 1} b LEFT JOIN mean{number} m ON b.part = m.part AND b.entry = m.entry
),"""


#: All rows and every distinct candidate score, as the operator's contract has them.
ORACLES: dict[str, str] = {
    "op6_exact_top_k": """
WITH usable AS (
    SELECT vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
    FROM (SELECT DISTINCT * FROM usable) a JOIN (SELECT DISTINCT * FROM usable) b
      ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
),
ranked AS (
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op12_vector_codes": f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS n, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
    SELECT n, CAST(part AS INTEGER) AS part,
           list_slice(q, part * (len(q) // 16) + 1, (part + 1) * (len(q) // 16)) AS v
    FROM kept, range(16) t(part)
),
book0 AS (SELECT part, n - 1 AS entry, v FROM parts WHERE n <= 64),
{_round_sql(1)}
{_round_sql(2)}
final AS (
    SELECT n, part, min(gap) AS gap, arg_min(entry, (gap, entry)) AS entry
    FROM (
        SELECT p.n, p.part, c.entry,
               list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS gap
        FROM parts p JOIN book2 c ON p.part = c.part
    ) GROUP BY n, part
),
coded AS (
    SELECT k.vec_id, k.label, c.code, c.error
    FROM kept k JOIN (
        SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error
        FROM final GROUP BY n
    ) c ON k.n = c.n
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM coded
""",
    "op13_fill_in_middle": r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
cut AS (
    SELECT doc_id, text,
           regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
),
formed AS (
    SELECT *, CAST(len(tokens) AS BIGINT) AS n,
           least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a,
           greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
),
parted AS (
    SELECT doc_id, n, form, text, array_to_string(list_slice(tokens, 1, a), '') AS p,
           array_to_string(list_slice(tokens, a + 1, b), '') AS m,
           array_to_string(list_slice(tokens, b + 1, len(tokens)), '') AS s
    FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
""",
    "op5_substring_dedup": r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
placed AS (
    SELECT doc_id, words, unnest(range(0, len(words) - 49)) AS spot FROM split WHERE len(words) >= 50
),
windows AS (
    SELECT doc_id, spot, array_to_string(list_slice(words, spot + 1, spot + 50), ' ') AS window_text FROM placed
),
gone AS (
    SELECT doc_id, spot
    FROM (SELECT doc_id, spot, min(doc_id) OVER (PARTITION BY window_text) AS first_id FROM windows)
    WHERE first_id < doc_id
),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(spot, spot + 50)) AS i FROM gone
),
placed_words AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM split),
kept AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS kept_text, count(*) AS n
    FROM placed_words w ANTI JOIN removed r ON w.doc_id = r.doc_id AND w.i = r.i
    GROUP BY w.doc_id
)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words,
       CAST(len(s.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
""",
}
