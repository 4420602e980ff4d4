"""From a CSV file to both stores."""

from pyspark.sql import DataFrame, SparkSession

from candlekit.schema import BAR_COLUMNS
from candlekit.sources.csv_bars import load_bars_csv, load_tickers_csv
from candlekit.sources.star_store import StarStore
from candlekit.sources.wide_store import WideStore


def build_star_store(
    spark: SparkSession, bars: DataFrame, path: str, metadata: DataFrame | None = None, validated: bool = False
) -> tuple[StarStore, int]:
    """Upsert bars into the star at `path`; returns the store and the rows written."""
    store = StarStore(spark, path)
    return store, store.upsert(bars, metadata, validated=validated)


def build_wide_store(
    spark: SparkSession,
    bars: DataFrame,
    path: str,
    partition_by_ticker: bool = True,
    append: bool = False,
    validated: bool = False,
    period: str | None = None,
) -> WideStore:
    """Load bars into the wide store at `path`.

    A partitioned store is upserted, so that loading a file again leaves it equal
    to the star; `append` only adds files. An unpartitioned store is replaced. `period` is as for
    `WideStore`.
    """
    extra = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}"
        for field in bars.schema.fields
        if field.name not in BAR_COLUMNS
    )
    store = WideStore(spark, path, partition_by_ticker, extra or None, period)
    if append or not partition_by_ticker:
        store.save(bars)
    else:
        store.upsert(bars, validated=validated)
    return store


def build_all_assets(
    spark: SparkSession, csv_path: str, tickers_path: str, star_path: str, wide_path: str
) -> dict:
    """Load and validate a CSV file and write both stores.

    The bars are read from the table that validation staged, so the text is
    parsed once for all three results.
    """
    tickers = load_tickers_csv(spark, tickers_path)
    bars = load_bars_csv(spark, csv_path, tickers.select("symbol"))
    star, rows = build_star_store(spark, bars, star_path, tickers, validated=True)
    wide = build_wide_store(spark, bars, wide_path, validated=True)
    return {"bars": bars, "rows_written": rows, "star": star, "wide": wide}
