"""A training-corpus pipeline over ``documents``.

Each stage works on all rows that the one before kept and is written as
Parquet in the shared folder before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm.bpe import encode_texts
from strata.llm.decontaminate import decontaminate
from strata.llm.jaccard import one_of_each
from strata.llm.lines import drop_shared_lines
from strata.llm.quality import keep_good, train
from strata.session import stored

#: Quality score from which a document stays.
MIN_QUALITY = 0.3
#: Words of a shingle, and the similarity (per cent) from which documents are near-duplicates.
SHINGLE, SIMILARITY = 5, 80


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, model, MIN_QUALITY)


def lines(spark, docs, sf_dir):
    """Lines that three or more documents share stay in one of them; ``n_chars`` follows the text."""
    out = drop_shared_lines(docs)                  # the two counts at the end go, whatever the columns of docs are called
    out = out.toDF(*map(str, range(len(out.columns)))).select(*map(str, range(len(docs.columns)))).toDF(*docs.columns)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return one_of_each(docs, k=SHINGLE, num=SIMILARITY, den=100)


def benchmark(spark, docs, sf_dir):
    """Documents that hold too much of the benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnamed=True)


def tokens(spark, docs, sf_dir):
    """Token ids of every document, with a digest of the ids and of the bytes that they decode to."""
    out = encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", benchmark), ("byte_bpe", tokens)]

#: The classifier's decisions are learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
