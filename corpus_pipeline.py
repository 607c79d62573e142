"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor wrote. Quality first, since counts of later
stages should not rest on junk; exact copies before near ones, near ones before
passages; what is left is packed.
"""

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, kneser_ney, packing, shingle_sets, substring
from ledgerloom.llm.common import table
from ledgerloom.sources.staging import new_location

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 0


def quality(spark, docs, sf_dir):
    """Documents whose perplexity is within the threshold of their language stay."""
    return kneser_ney.kept_rows(docs, table(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """Of documents equal without white space the longest stays."""
    return exact_dedup.kept_rows(docs)


def near(spark, docs, sf_dir):
    """Of documents linked by a 5-word shingle similarity of 0.8 the one with the smallest doc_id stays.

    SimHash fingerprints bring them together and the similarity is checked; what fingerprints miss comes from shared shingles.
    """
    return shingle_sets.kept_rows(docs)


def passages(spark, docs, sf_dir):
    """Words in 35-word windows that occur elsewhere go; documents without a word left go."""
    return substring.shortened_rows(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark, docs, sf_dir):
    """Token pieces with their sequence and offset."""
    return packing.pack(docs, TOKENIZER, END).drop("ids")


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("substring_dedup", passages),
    ("best_fit_packing", pack),
]


def run(spark, sf_dir):
    """All stages on the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        location = new_location(spark, name)
        stage(spark, docs, sf_dir).write.parquet(location)
        docs = spark.read.parquet(location)
    return docs


#: The classifier is a trained model, which SQL does not express; tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
