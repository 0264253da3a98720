"""A corpus from raw documents: five stages, each on all rows that the one before kept."""

import public_tokenizers
from pyspark.sql import functions as F

from trendmill.llm import bpe, contamination, pii, quality, simhash
from trendmill.llm.shared import table
from trendmill.session import written

#: Vocabulary file of the last stage.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark, docs, sf_dir):
    """Drops documents that the byte network, learned from the labels, scores below 0.3."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_distinct(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark(spark, docs, sf_dir):
    """Drops documents that hold a passage of a benchmark item."""
    return contamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_private(spark, docs, sf_dir):
    """Replaces personal data by its kind; ``n_chars`` follows where the text has changed."""
    before = "_".join(["before", *docs.columns])
    masked = pii.mask_personal_data(docs.withColumn(before, F.char_length("text")))
    now = F.char_length("text")
    return masked.withColumn(
        "n_chars", F.when(now == F.col(before), F.col("n_chars")).otherwise(F.coalesce(now.cast("long"), "n_chars"))
    ).select(docs.columns)


def tokenize(spark, docs, sf_dir):
    """Tokens of every document, with digests of the ids and of the text they decode to."""
    return bpe.digests(docs, VOCABULARY, keep=("lang", "source"), ids=True)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_private),
    ("tokens", tokenize),
]

#: Learned scores and tokens have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the table ``documents`` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
