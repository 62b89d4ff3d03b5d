"""The registered queries of the training-data operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import audio, html_extract, licenses, ngram_lm, packing, pii, quality, sentencepiece_codec, simhash, substring_dedup
from .common import table

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=2048)
    return packing.pack(pieces, capacity=2048)[0]


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op5_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.digest(audio.features(audio.store(table(spark, sf_dir, "documents"))))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), "corpus-1").select("doc_id", *quality.MEASURES[:5], "base_failed", "kept", "failed", "policy")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy costs, from the stored ledger: the texts are read once."""
    return quality.ablation(quality.stored_ledger(table(spark, sf_dir, "documents")), "corpus-1")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op9_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), order=2)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_simhash_near_dedup,
        op3_sentencepiece,
        op4_license_scan,
        op5_audio_features,
        op6_quality_rules,
        op7_html_extraction,
        op8_substring_dedup,
        op9_ngram_lm,
        op10_personal_data,
        quality_ablation,
    )
}

_WORDS = r"w AS (SELECT doc_id, coalesce(text, '') AS t, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents)"

_LEDGER = rf"""WITH {_WORDS},
g AS (SELECT doc_id, k, words[k] AS a, words[k + 1] AS b, words[k + 2] AS c FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS k FROM w)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
v AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, t, words, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM w),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
 len(lines) AS n_lines, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_alpha, len([x FOR x IN words IF x = '|']) AS n_bar_words,
 len(regexp_extract_all(t, '(?i)\b(?:{"|".join(quality.ABUSE)})\b')) AS n_toxic FROM l LEFT JOIN v USING (doc_id)),
f AS (SELECT *, {" + ".join(f"CASE WHEN {condition} THEN {1 << k} ELSE 0 END" for k, (_, condition) in enumerate(quality.RULES))} AS failed FROM m)"""

#: SQL for the queries that it can express; tests hold the others against brute-force versions.
ORACLES: dict[str, str] = {
    "op6_quality_rules": rf"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {quality.mask(quality.BASE_RULES)}) <> 0 AS base_failed, (failed & {quality.mask("corpus-1")}) = 0 AS kept, CAST(failed AS BIGINT) AS failed, 'corpus-1' AS policy FROM f""",
    "quality_ablation": rf"""{_LEDGER}, b AS (SELECT CAST(failed & {quality.mask("corpus-1")} AS BIGINT) AS failed FROM f), z AS (SELECT unnest([{", ".join(f"'{name}'" for name in quality.POLICIES["corpus-1"])}]) AS rule, unnest([{", ".join(str(quality.mask((name,))) for name in quality.POLICIES["corpus-1"])}]) AS bit)
SELECT count(*) AS n, count(*) FILTER (failed = 0) AS kept, rule, count(*) FILTER ((failed & bit) <> 0) AS failed, count(*) FILTER (failed = bit) AS failed_alone, count(*) FILTER (failed = 0 OR failed = bit) AS kept_without FROM b, z GROUP BY rule, bit""",
    "op8_substring_dedup": rf"""WITH {_WORDS},
k AS (SELECT doc_id, k, array_to_string(words[k:k + 49], ' ') AS x FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM w WHERE len(words) >= 50)),
d AS (SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY x) AS first FROM k) WHERE first < doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM d),
p AS (SELECT doc_id, words[i] AS word, i FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
s AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS t FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.p = p.i WHERE g.p IS NULL GROUP BY p.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(s.t, '')) AS kept_sha256 FROM w LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)""",
}
