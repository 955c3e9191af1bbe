"""The corpus pipeline: five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is stored as Parquet and
read again as the next stage's docs. The first four return the columns of `documents`;
the last returns token ids, the digests of ids and decoded bytes, and the position in the
schedule of sources.
"""

import public_tokenizers
from pyspark.sql import functions as F

from threadglean.llm import fm_dedup, jaccard_join, merge_replay, mixing, toxicity
from threadglean.llm.queries import CATEGORIES
from threadglean.operators.scale import cut_lineage
from threadglean.session import prepare_workers


def drop_toxic(spark, docs, sf_dir):
    """Rows whose text the classifier chain, trained on `labels`, does not reject (1)."""
    prepare_workers(spark)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CATEGORIES)
    return toxicity.keep_clean(docs, chain)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group linked by shingle similarity (10); a repeated id with
    unlike texts is several documents."""
    prepare_workers(spark)
    return jaccard_join.keep_one(docs, tied=False)


def cut_repeated_passages(spark, docs, sf_dir):
    """All documents; windows of 13 words that a document of a smaller id has go (4)."""
    prepare_workers(spark)
    return fm_dedup.rewrite(docs)


def _scheduled(docs):
    """All documents with `position` in the Pfair schedule of sources (3).

    A source weighs the square root of its number of documents. Only equal rows are
    interchangeable, so the same documents always get the same positions.
    """
    marked = docs.withColumn("__text_hash", F.xxhash64("text"))
    return mixing.mix(marked, order_cols=("doc_id", "__text_hash")).drop("__text_hash")


def mix_sources(spark, docs, sf_dir):
    """All documents in the order of the schedule.

    Files hold consecutive stretches of it, each a mixture by the weights. Readers don't
    keep the order of files, so the last stage returns the positions.
    """
    return mixing.in_order(_scheduled(docs)).select(*docs.columns)


def encode(spark, docs, sf_dir):
    """Ids of every text by byte-level BPE, digests of ids and decoded bytes (9), and the
    document's `position` in the schedule (3)."""
    prepare_workers(spark)
    return merge_replay.encode_decode(
        _scheduled(docs), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
        with_ids=True, keep=("position",))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

# Trained models, digests of token ids and the schedule's hashes can't be expressed in SQL;
# tests/llm runs a brute-force version of each stage.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
