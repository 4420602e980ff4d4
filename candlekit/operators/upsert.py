"""Insert-or-replace by key, and numbering of new dimension rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlekit.schema import TICKERS_SCHEMA, ValidationError, quoted
from candlekit.session import stage


def last_write(batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the one with the largest `order` value, which must be unique in a key
    and not null (`require_order` tells).

    Without an order column the rows of a DataFrame have no first and last; they are
    returned as they are, and `require_unique` tells whether that will do.
    """
    if not order:
        return batch
    # Per column, as fixed-width buffers keep the aggregation a hash aggregation.
    values = [F.max_by(F.col(f"`{name}`"), F.col(order)).alias(name) for name in batch.columns if name not in keys]
    return batch.groupBy(*keys).agg(*values).select(*[F.col(f"`{name}`") for name in batch.columns])


def require_unique(batch: DataFrame, keys: list[str]) -> None:
    """Raise ValidationError if a key has several rows."""
    repeated = batch.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").count()
    if repeated:
        raise ValidationError(f"Found {repeated} keys with several records; name the column that orders them")


def require_order(batch: DataFrame, keys: list[str], order: str) -> None:
    """Raise ValidationError if rows have no `order` value, or one that another row of their key has."""
    value = F.col(order)
    per_value = batch.groupBy(*keys, value.alias("_order")).agg(F.count("*").alias("_rows"))
    missing = F.coalesce(F.sum(F.when(F.col("_order").isNull(), F.col("_rows"))), F.lit(0))
    tied = F.count_if(F.col("_order").isNotNull() & (F.col("_rows") > 1))
    found = per_value.agg(missing.alias("missing"), tied.alias("tied")).first()
    if found["missing"]:
        raise ValidationError(f"Found {found['missing']} records without a value of {order}, which orders them")
    if found["tied"]:
        raise ValidationError(f"Found {found['tied']} values of {order} that several records of a key have")


def merge(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` without the keys of `batch`, plus `batch`."""
    columns = existing.columns
    kept = existing.join(batch.select(*keys), keys, "left_anti").select(*quoted(columns))
    return kept.unionByName(batch.select(*quoted(columns)))


def number_rows(df: DataFrame, order: str, column: str, first: int) -> DataFrame:
    """Add consecutive numbers in the order of one column, starting at `first`.

    Every range partition counts its own rows; the offsets come from one row per
    partition. The partitioned rows are staged, as a second evaluation could cut
    the ranges elsewhere. So no task sees all rows.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = stage(
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumns({"_part": F.spark_partition_id(), "_position": position}),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per shuffle partition.
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    numbered = ranged.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.lit(first) + F.col("_offset") + F.col("_position")).alias(column))


def new_dimension_rows(dimension: DataFrame, symbols: DataFrame) -> DataFrame:
    """Dimension rows for the symbols that `dimension` does not have yet.

    `symbols` has a symbol column and may have name and exchange. Known symbols
    keep their id and are not updated. New ids follow the largest known id in
    symbol order.
    """
    described = [name for name in ("name", "exchange") if name in symbols.columns]
    wanted = (
        symbols.select("symbol", *described)
        .filter("symbol is not null")
        .groupBy("symbol")
        # Name and exchange of one row, not the largest of each.
        .agg(F.max(F.struct(*[F.col(name) for name in described] or [F.lit(0).alias("none")])).alias("row"))
        .select("symbol", *[F.col(f"row.{name}").alias(name) for name in described])
    )
    unknown = wanted.join(dimension.select("symbol"), "symbol", "left_anti")
    if unknown.isEmpty():
        return dimension.sparkSession.createDataFrame([], TICKERS_SCHEMA)
    largest = dimension.agg(F.coalesce(F.max("ticker_id"), F.lit(0))).first()[0]
    numbered = number_rows(unknown, "symbol", "ticker_id", largest + 1)
    for name in ("name", "exchange"):
        if name not in described:
            numbered = numbered.withColumn(name, F.lit(None).cast("string"))
    return numbered.withColumn("created_at", F.current_timestamp()).select(*TICKERS_SCHEMA.fieldNames())


def dimension_upsert(dimension: DataFrame, symbols: DataFrame) -> DataFrame:
    """`dimension` with a row for every symbol."""
    return dimension.unionByName(new_dimension_rows(dimension, symbols))
