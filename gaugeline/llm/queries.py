"""Registered queries of the corpus operators, and their SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (decontamination, embedding_dedup, language_id, lexical_search, minhash,
                           packing, quality, quality_rules, secret_scan, substring_dedup, token_counts,
                           url_filter, whitening)
from gaugeline.llm.common import table, workers_import_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"),
             url_filter.Rule("www.example.com", "/en/", "allow"),
             url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block"))


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_import_package(spark)
        return fn(spark, sf_dir)
    run.__doc__, run.__name__ = fn.__doc__, fn.__name__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secret_scan.train(secret_scan.pattern_labelled(docs))
    found = secret_scan.with_secret_spans(docs, model)

    def count(kind):  # a second parameter of the lambda, even one with a default, would be the index
        return F.size(F.filter("base_found", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.BASE)]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.joined(F.col("base_found")), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("all_found")).alias("spans"))


@query
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    return (language_id.predict(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query
def op4_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op5_token_counts(spark, sf_dir):
    return token_counts.with_token_counts(table(spark, sf_dir, "documents"),
                                          public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_quality(spark, sf_dir):
    return quality.importance_resample(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "labels"))


@query
def op7_decontamination(spark, sf_dir):
    found = decontamination.find_passages(table(spark, sf_dir, "documents"),
                                          table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.hit_words(F.col("hits"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near_items"))


@query
def op8_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op9_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op10_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.rule_labelled(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule",
                                                            "verdict")


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


@query
def op12_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"), most=20)


ORACLES["op12_lexical_search"] = r"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    items AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
    total AS (SELECT count(*) FILTER (len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms
        FROM docs),
    counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
        GROUP BY r, term),
    weights AS (SELECT term, CAST(floor(1000 * ln((2::DOUBLE * any_value(docs) + 2)
        / (2::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM counted, total GROUP BY term),
    lengths AS (SELECT r, doc_id, 75 + (25 * len(t) * docs) // terms AS m FROM docs, total),
    wanted AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(t) AS term FROM items)
        GROUP BY i, term),
    scored AS (SELECT i, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))
        AS BIGINT) AS score FROM wanted JOIN counted USING (term) JOIN weights USING (term)
        JOIN lengths USING (r) GROUP BY i, r),
    placed AS (SELECT i, r, score, doc_id, row_number() OVER (PARTITION BY i ORDER BY score DESC,
        doc_id NULLS LAST) AS p FROM scored JOIN lengths USING (r) WHERE score > 0)
    SELECT item_id, CAST(p AS INT) AS rank, doc_id, score FROM placed JOIN items USING (i)
    WHERE p <= 20"""


@query
def op13_quality_rules(spark, sf_dir):
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))
