"""One registered query per operator, over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bibspark.llm.collocations import collocations
from bibspark.llm.decontaminate import contamination
from bibspark.llm.fingerprints import fingerprints
from bibspark.llm.jaccard_join import jaccard_components
from bibspark.llm.line_dedup import line_dedup
from bibspark.llm.packing import pack
from bibspark.llm.periodic_runs import periodic_runs, run_digests, with_planted_runs
from bibspark.llm.pii_crf import pii_spans, span_digests
from bibspark.llm.ppm import score
from bibspark.llm.quality import weights
from bibspark.llm.rows import table
from bibspark.llm.sentence_spans import span_dedup
from bibspark.llm.suffix_dedup import suffix_dedup
from bibspark.llm.token_counts import token_counts

TOKENIZER = "byte_bpe_50k.json"


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup(documents(spark, sf_dir))


def op4_sparse_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op5_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weights(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_grams", "log_weight", "gumbel_key", "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer())


def op7_partial_matching_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


def op8_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer())


def op10_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(pii_spans(documents(spark, sf_dir)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(documents(spark, sf_dir))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_benchmark_decontamination, op3_sentence_span_dedup, op4_sparse_suffix_dedup,
        op5_quality_resampling, op6_token_counts, op7_partial_matching_score, op8_line_edit_dedup,
        op9_mixture_packing, op10_imatch_fingerprints, op11_phrase_collocations, op12_pii_spans,
        op13_periodic_runs, pipeline,
    )
}
#: The other queries cannot be said in SQL in a time that whole tables allow; tests hold
#: each against a brute-force version, an exact round trip or held-out documents.
ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM documents
        ), items AS (
            SELECT coalesce(item_id :: VARCHAR, 'null') AS item, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM benchmark
        ), item_places AS (
            SELECT item, w, least(13, len(w)) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
            FROM items WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS gram FROM item_places
        ), doc_places AS (
            SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
        ), hits AS (
            SELECT k, i, size, item
            FROM (SELECT k, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram FROM doc_places)
            JOIN windows USING (size, gram)
        ), words AS (
            SELECT k, count(DISTINCT place) AS n_hit
            FROM (SELECT k, unnest(range(i, i + size)) AS place FROM hits) GROUP BY k
        ), found AS (
            SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k
        )
        SELECT doc_id, len(w) :: BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN words USING (k) LEFT JOIN found USING (k)
    """,
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), runs AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), sizes AS (SELECT lang, sum(len(w)) AS n FROM runs GROUP BY lang),
        places AS (
            SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM runs, (VALUES (1), (2), (3), (4), (5)) AS lengths(k) WHERE len(w) >= k
        ), phrases AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
            FROM places GROUP BY ALL HAVING count(*) >= 100
        ), many AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, a FROM phrases WHERE k > 1),
        parts AS (
            SELECT lang, w, a, s, unnest(range(1, k - s + 2)) AS i
            FROM many, (VALUES (2), (3), (4)) AS lengths(s) WHERE s < k
        ), inside AS (
            SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer FROM parts GROUP BY ALL
        ), kept AS (
            SELECT many.* FROM many LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
        ), cuts AS (
            SELECT lang, phrase, a, c, array_to_string(w[1 : c], ' ') AS head, array_to_string(w[c + 1 : k], ' ') AS rest
            FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, cuts.a, c, h.a AS l, t.a AS r, sizes.n,
                (1000 :: HUGEINT * cuts.a * sizes.n) // (h.a :: HUGEINT * t.a) AS score
            FROM cuts JOIN phrases h ON h.lang = cuts.lang AND h.phrase = head
            JOIN phrases t ON t.lang = cuts.lang AND t.phrase = rest JOIN sizes ON sizes.lang = cuts.lang
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
        )
        SELECT lang, rank, phrase, a, l, r, n :: BIGINT AS n, score :: BIGINT AS score FROM ranked WHERE rank <= 2000
    """,
}
