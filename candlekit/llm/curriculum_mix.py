"""Mixing sources to target weights along a curriculum that changes over time.

Training time runs from 0 to 1. Source s is drawn at the rate
``rate_s(t) = 1 + slope_s * (2 t - 1)`` times its mean rate, a straight line, so the
share of its demand met until time t is the integral

    demand_s(t) = t + slope_s * (t * t - t)

which is 0 at 0 and 1 at 1. A source lays its documents out in a fixed shuffled
order, pass after pass, until its target is met. A document whose words end at
word c of that line is trained on when the demand has reached c, that is at the t
that solves demand_s(t) = c / target. The mix is the documents sorted by t.

Only DataFrame expressions are used. All sums over a source are taken in two
levels (buckets of the shuffled order, then rows of a bucket), so that a source
with a third of all rows is spread over `BUCKETS` groups.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BUCKETS = 1024
SLOPES = (-0.9, 0.0, 0.9)
#: The word separators, as characters and as a pattern.
SEPARATORS = " \t\n\u000b\f\r"
SEPARATOR_RUN = "[\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of runs of other characters than separators; 0 for null."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SEPARATOR_RUN))).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Targets of the sources, from a row per source: source, source_size.

    The rows in code point order, null last, have the weights in turn. All targets
    together are `share` times all sizes, divided by weight; none exceeds `repeats`
    times its source's size, and the excess goes to the others by weight. At the
    end of that, the sources with the smallest size per weight are at their limit
    and the others have the same target per weight, which is found by going through
    the sources in the order of size per weight.

    The windows here see one row per source, not the documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_turn") + 1)
    limit = F.lit(float(repeats)) * F.col("source_size")
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("_turn", F.col("_rank") % len(weights))
        .withColumn("weight", weight)
        .withColumn("_limit", limit)
        .withColumn("_ratio", F.col("_limit") / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(all_rows) * F.lit(float(share)))
    )
    level = (F.col("_all") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    first = F.struct("_ratio", F.col("source").isNull().alias("unnamed"), "source", "_level")
    return (
        ranked.withColumn("_level", level)
        # The first source whose limit is not reached sets the level of all after it.
        .withColumn("_first", F.min(F.when(F.col("_level") <= F.col("_ratio"), first)).over(all_rows))
        .select(
            "source",
            "source_size",
            "weight",
            "_rank",
            F.least(F.col("_limit"), F.coalesce("_first._level", F.col("_ratio")) * F.col("weight")).alias("target"),
        )
    )


def _time(part: Column, slope: Column) -> Column:
    """The t in 0..1 for which t + slope * (t * t - t) = part."""
    linear = 1 - slope
    root = F.sqrt(F.greatest(linear * linear + 4 * slope * part, F.lit(0.0)))
    # The form without cancellation; it holds for slope 0 as well.
    return F.least(F.lit(1.0), 2 * part / F.greatest(linear + root, F.lit(1e-12)))


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS, slopes=SLOPES, carry: list[str] | None = None
) -> DataFrame:
    """`docs` with size, source_size, target, taken and positions.

    `size` is the number of words of the document, `target` the words its source is
    to give, `taken` the words taken of the document over all passes and `positions`
    the training times (0 to 1) at which the passes over it end; it is empty for a
    document that is not taken. The document at which a source meets its target is
    taken in part, so the words taken of a source are its target, rounded down.

    A null text has no words; a document without words is never taken. A null source
    is a source. The order within a source is that of a hash of doc_id, then doc_id,
    size and a hash of the text; rows equal in all are interchangeable. `carry` names
    the columns to keep, all if not given; columns of the result's names are replaced
    and the others are carried along, whatever their names. An empty table gives an
    empty result. `docs` is read twice and must give the same rows each time.
    """
    added = ("size", "source_size", "target", "taken", "positions")
    carried = [name for name in (docs.columns if carry is None else carry) if name not in added]

    def keyed(columns: list[str]) -> DataFrame:
        rows = docs.select(
            F.struct(F.lit(0).alias("_none"), *[F.col(f"`{name}`") for name in columns]).alias("_row"),
            F.col("source").alias("_source"),
            F.col("doc_id").alias("_id"),
            F.xxhash64("doc_id", "text").alias("_mark"),
            word_count().alias("size"),
        ).withColumn("_hash", F.xxhash64(F.coalesce("_id", "_mark"), F.lit(7)))
        return rows.withColumn("_bucket", F.pmod(F.shiftright("_hash", 20), F.lit(BUCKETS)))

    rows, narrow = keyed(carried), keyed([])
    buckets = narrow.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    sizes = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, share, repeats)
    slope = F.element_at(F.array(*map(F.lit, slopes)), (F.col("_rank") % len(slopes) + 1).cast("int"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        buckets.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .join(
            targets.select(F.col("source").alias("_name"), "source_size", "target", slope.alias("_slope")),
            F.col("_source").eqNullSafe(F.col("_name")),
        )
        .select(
            F.col("_source").alias("_name"),
            F.col("_bucket").alias("_number"),
            "_start",
            "source_size",
            "target",
            "_slope",
        )
    )

    order = Window.partitionBy("_source", "_bucket").orderBy("_hash", "_id", "size", "_mark")
    line = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = rows.withColumn("_line", line).join(
        starts, F.col("_source").eqNullSafe(F.col("_name")) & (F.col("_bucket") == F.col("_number"))
    )
    begin = F.col("_start") + F.col("_line")
    whole = F.floor("target")
    takes, times = [], []
    for turn in range(repeats):
        at = begin + turn * F.col("source_size")
        take = F.least(F.greatest(whole - at, F.lit(0)), F.col("size"))
        part = F.least(F.lit(1.0), (at + F.col("size")) / F.col("target"))
        takes.append(take)
        times.append(F.when(take > 0, _time(part, F.col("_slope"))))
    return placed.select(
        *[F.col(f"_row.`{name}`") for name in carried],
        "size",
        "source_size",
        "target",
        sum(takes[1:], takes[0]).cast("long").alias("taken"),
        F.array_compact(F.array(*times)).alias("positions"),
    )


def training_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row per document and pass, range-sorted by training time, with column position."""
    passes = mixed.withColumn("position", F.explode("positions"))
    if partitions:
        return passes.repartitionByRange(partitions, "position").sortWithinPartitions("position", "doc_id")
    return passes.orderBy("position", "doc_id")
