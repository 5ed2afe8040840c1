"""The corpus pipeline over documents: language ID, line dedup, near-duplicates, decontamination, tokens.

Every stage is a function of (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return
the columns of documents. What a stage decides takes effect:

* language: documents without a language (no letter) go; a null ``lang`` is filled with the prediction, or
  stays where there is no labelled text to learn from;
* lines: repeated lines go, ``n_chars`` follows the kept text; a document of which they leave nothing but blanks goes, as all
  of it stands in others;
* near copies: the smallest id of every group stays; rows that share an id, or have none, are judged each by their own text
  (equal ids with equal texts as one);
* decontamination: documents with a verified benchmark overlap go;
* tokens: byte-level BPE ids of the kept texts, decoded again and compared with the text.

Null ids, texts, languages and sources pass through as the operators define them; an empty table passes as one. run() logs
how many rows each stage keeps.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import bpe, decontaminate, langid, line_dedup, minhash
from courtside.llm.common import BLANKS, NO_ID, durable

logger = logging.getLogger(__name__)

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The vocabulary file of the installed tokenizer package that the last stage encodes with.
RANKS = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = langid.fit(langid.train_part(docs).select("text", "lang"))
    if model is None:  # nothing to learn from: a null lang stays
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = langid.identify(docs, model, carry=COLUMNS).where(F.col("lang_pred") != langid.NONE)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs, carry=("lang", "source", "n_chars"))
    kept = kept.where((F.col("n_dropped") == 0) | (F.btrim("kept_text", F.lit(BLANKS)) != ""))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # each distinct id and text gets a number of its own in the order of ids, so rows that share an id (or have none) are judged apart
    key = ["_id", "_h1", "_h2"]
    hashes = [F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(7), "text").alias("_h2")]
    own = docs.select(*COLUMNS, F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), *hashes)
    numbers = durable(own.select(*key).distinct().sort(*key).withColumn("_row", F.monotonically_increasing_id()))
    numbered = durable(own.join(numbers, key).select("_row", *COLUMNS))
    kept = minhash.near_duplicates(numbered, id_col="_row", words=5, percent=80).where("kept").select("_row").distinct()
    return numbered.join(kept, "_row", "left_semi").select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, tests, carry=COLUMNS).where(~F.col("contaminated")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, tokens, and whether decoding them gives the text's bytes."""
    import public_tokenizers

    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path(RANKS))
    out = bpe.encode(docs, ranks, public_tokenizers.PATTERN, carry=("lang", "source", "text"), decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens", same.alias("round_trip"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_duplicates", near_copies),
    ("decontamination", benchmark_free),
    ("bpe_tokens", tokens),
]

#: Hashing, trained weights and the vocabulary cannot be stated in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
        logger.info("%s keeps %d rows", name, docs.count())
    return STAGES[-1][1](spark, docs, sf_dir)
