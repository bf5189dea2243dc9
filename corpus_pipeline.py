"""From raw documents to token ids: five stages, each written and read again before the next.

A stage takes (spark, documents, folder of the tables) and gives the documents that it keeps;
the last one gives their token ids. The stages have no SQL form as a whole (a trained field,
fingerprints of all shingles), so the tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitval.llm import decontaminate, pieces, quality_lines, simhash, suffixes
from pitval.llm.common import read
from pitval.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rule, or are mostly boilerplate, go."""
    return quality_lines.keep_good(docs, read(spark, folder, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of texts whose fingerprints link stays (op6's shingles and distance)."""
    return simhash.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that stand earlier too are cut out; a document stays even if little is left."""
    return suffixes.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def contamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold enough of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read(spark, folder, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of each text's pieces, and their number."""
    made = pieces.encode(docs.select("doc_id", "text"), pieces.tokenizer_path("piece_bpe_32k.model"))
    return made.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_copies),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", contamination),
    ("sentencepiece encoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
