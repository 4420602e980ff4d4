"""From raw documents to shards of training data.

STAGES run in order; each reads what the one before wrote. All but the last return the
columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlekit.llm.bounded_ring import shard_rows
from candlekit.llm.containment_search import without_contained
from candlekit.llm.curriculum_mix import mix_sources, training_order
from candlekit.llm.jaccard_join import linked_sets, row_mark
from candlekit.llm.language_masks import UNKNOWN, identify, train
from candlekit.session import stage

#: A text of at least that many characters is rejected if no language has that share of its n-grams.
JUDGED_CHARS = 40
LEAST_SCORE = 0.2
SHARDS = 8


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled documents.

    Rejected are texts that are null or have no letter, and texts long enough to judge in
    which hardly any n-gram belongs to the predicted language. Columns with the names of the
    judgement come back as they were.
    """
    names, docs = _set_aside(docs, "lang_pred", "score")
    judged = identify(docs, train(docs.select("text", "lang")))
    doubtful = (F.length("text") >= JUDGED_CHARS) & (F.col("score") < LEAST_SCORE)
    return judged.filter((F.col("lang_pred") != UNKNOWN) & ~doubtful).select(*names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents linked by shingles, directly or not, the one with the smallest doc_id.

    Documents without words stay. Rows without doc_id are linked like the others and come
    after those with one; among rows of one doc_id the hash of the text decides. Rows equal
    in doc_id and text to the one that stays all stay.
    """
    found = linked_sets(docs.select("doc_id", "text"), nameless=True).filter("n_shingles > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    stays = found.groupBy("component").agg(F.min(rank).alias("stays"))
    dropped = found.withColumn("rank", rank).join(stays, "component").filter("rank != stays")
    gone = dropped.select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_gone"]) & (row_mark() == gone["_mark"])
    return docs.join(gone, same, "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per pass over them, in training order.

    The document at which a source meets its target is returned whole. Columns with the
    names of the mix's figures come back as they were.
    """
    names, docs = _set_aside(docs, "size", "source_size", "target", "taken", "positions", "position")
    return training_order(mix_sources(docs)).select(*names)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return shard_rows(docs, SHARDS)


def _set_aside(docs: DataFrame, *used: str) -> tuple[list, DataFrame]:
    """The columns that undo the second value: `docs` with other names for its columns named as in `used`."""
    free = {name: "_" * max(map(len, docs.columns)) + name for name in docs.columns if name.lower() in used}
    return [F.col(f"`{free.get(name, name)}`").alias(name) for name in docs.columns], docs.withColumnsRenamed(free)


STAGES = [
    ("language", known_language),
    ("jaccard", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: SQL expresses neither the learned language model nor the components of links.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
