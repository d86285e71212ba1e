"""The thirteen operators as registered queries over their whole tables, and the pipeline.

Every query gets its rows through its operator; what is added here is the digest
that the driver compares.  ``ORACLES`` has DuckDB SQL where SQL can express the
result on whole tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.llm import (embedding_dedup, exact_dedup, licenses, line_dedup, lm_scoring, minhash, mixing, packing,
                          quality, spelling, token_counts, url_filters, vector_codes)
from cohortia.llm.oracles import SPELLING, VECTOR_CODES
from cohortia.llm.scratch import store


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: (host, path, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    """Pieces of all documents in 4096-token sequences."""
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    """Lines that an earlier line matches within one word; short ones that equal an earlier line."""
    return line_dedup.repeated_lines(_table(spark, sf_dir, "documents"), equal_words=1).drop("text_hash")


def op4_quality(spark, sf_dir):
    return quality.classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_counts(spark, sf_dir):
    """Token count of every document of the flat files; files are named by their number."""
    counts = token_counts.document_token_counts(_table(spark, sf_dir, "documents"), tokenizer())
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    chunk = F.regexp_extract("file", r"-c(\d+)\.", 1).cast("int")
    return counts.select(part.alias("part"), chunk.alias("chunk"), "doc_no", "start", "n_tokens")


def op6_minhash(spark, sf_dir):
    return minhash.minhash_dedup(_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark, sf_dir):
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"), tokenizer())


def op8_url_filters(spark, sf_dir):
    judged = url_filters.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return (mix.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.size("draws")).cast("long").alias("taken")))


def op11_vector_codes(spark, sf_dir):
    """Code and errors of every vector, and a digest of the codebooks."""
    codes, books = vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))
    codes = store(codes, "codes")
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    errors = store(vector_codes.label_errors(codes), "label-errors").withColumnRenamed("label", "of")
    return codes.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_spelling(spark, sf_dir):
    """Words of all documents, their near words, forms and roots."""
    return spelling.spelling_groups(spelling.word_counts(_table(spark, sf_dir, "documents")))


def op13_licenses(spark, sf_dir):
    """Base places and all labels of every document."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    start = F.transform(base, lambda p: p["start"])
    names = F.array_join(F.sort_array(F.array_distinct(F.transform(base, lambda p: p["label"]))), ",")
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(start).alias("first_word"),
                        F.array_max(start).alias("last_word"), names.alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def pipeline(spark, sf_dir):
    """The stages of ``corpus_pipeline``, each reading what the one before has written."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_exact_dedup, op3_line_dedup, op4_quality, op5_token_counts, op6_minhash,
                            op7_lm_scoring, op8_url_filters, op9_embedding_dedup, op10_mixing,
                            op11_vector_codes, op12_spelling, op13_licenses, pipeline)}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op8_url_filters": r"""
        WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
                   FROM pages),
        q AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        s AS (SELECT *, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM q)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM s""",
    "op11_vector_codes": VECTOR_CODES,
    "op12_spelling": SPELLING,
}
