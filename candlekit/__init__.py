"""Validated OHLCV bars on Spark: load, store, query, audit."""

from candlekit.plans.build import build_all_assets, build_star_store, build_wide_store
from candlekit.plans.engine import QueryEngine
from candlekit.schema import BARS_SCHEMA, PRICES_SCHEMA, TICKERS_SCHEMA, ValidationError
from candlekit.session import build_session
from candlekit.sources.csv_bars import load_and_validate, load_bars_csv, load_tickers_csv
from candlekit.sources.star_store import StarStore
from candlekit.sources.wide_store import WideStore

__all__ = [
    "BARS_SCHEMA",
    "PRICES_SCHEMA",
    "TICKERS_SCHEMA",
    "QueryEngine",
    "StarStore",
    "ValidationError",
    "WideStore",
    "build_all_assets",
    "build_session",
    "build_star_store",
    "build_wide_store",
    "load_and_validate",
    "load_bars_csv",
    "load_tickers_csv",
]
