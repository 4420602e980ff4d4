"""Exact deduplication that combines in three steps and compares whole texts.

1. Rows of one input partition are combined by (digest, salt, text) before any
   row is shuffled.
2. The groups of one salt are merged. The salt comes from the row's id, so the
   copies of a text that fills a third of the table go to many tasks.
3. The winners of the salts are combined by (digest, text).

Text is part of the grouping key of every step, so a digest that two texts share
merges nothing. Rows find their group by the digest; where a digest does belong
to several texts, by digest and text.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlekit.session import stage


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, salts: int = 64, digest=_sha256) -> DataFrame:
    """For every row of `docs`: doc_id, keep_id, group_size, kept, digest.

    A null text is an empty one. Of equal texts the row with the largest doc_id is
    kept; a null doc_id is smaller than any other. Rows that repeat both doc_id
    and text are interchangeable; one of them is kept. An empty table gives an
    empty result. Other columns are not read.
    """
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", body.alias("_body"), digest(body).alias("_digest"))
    salted = (
        rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("_digest", "_salt", "_body")
        .agg(F.max("doc_id").alias("_top"), F.count("*").alias("_rows"))
    )
    groups = salted.groupBy("_digest", "_body").agg(
        F.max("_top").alias("keep_id"), F.sum("_rows").alias("group_size")
    )
    found = stage(groups.select("_digest", "keep_id", "group_size"), "exact-groups")

    # Numbered before the join, so that the join can split a digest with many rows.
    copy = F.row_number().over(Window.partitionBy("_digest", "_body", "doc_id").orderBy("doc_id"))
    if found.groupBy("_digest").count().filter("count > 1").isEmpty():
        same = Window.partitionBy("_digest", "doc_id").orderBy("doc_id")
        members = rows.select("doc_id", "_digest").withColumn("_copy", F.row_number().over(same))
        joined = members.join(found, "_digest")
    else:
        joined = rows.withColumn("_copy", copy).join(groups, ["_digest", "_body"])
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_digest").alias("digest"),
    )
