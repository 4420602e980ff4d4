"""Bars as one wide Parquet table, partitioned by ticker, by ticker and period, or not at all."""

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlekit.operators.integrity import StoreIntegrity, check_store
from candlekit.operators.prices import Moment, for_ticker, in_window, moment
from candlekit.operators.upsert import last_write, require_order, require_unique
from candlekit.schema import BAR_COLUMNS, BARS_SCHEMA, KEY_COLUMNS, PERIOD_COLUMNS, ValidationError, quoted
from candlekit.session import staged
from candlekit.sources.files import read_text, subfolders, write_text
from candlekit.sources.tables import (
    conform,
    finish_replacements,
    ordered,
    read_table,
    reporting,
    stored_fields,
    upsert_table,
    write_table,
)

# Symbols whose partition folder has the same name.
PLAIN_SYMBOL = r"[A-Za-z0-9._-]+"

#: The columns and the layout, written with the table. Spark skips the name.
DESCRIPTION = "_table.json"


class WideStore:
    """The table at `path`.

    Columns beyond the bar columns belong to the stored table and are found there; `extra`, a
    DDL string, declares further ones that a batch may bring.

    `period`, "month" or "year", adds a folder level below the ticker, so that a time range opens
    only its periods. It is worth its files where a ticker has many bars in a period (minutes
    or ticks, not days). It counts for a new table; a stored one keeps its layout.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partitioned: bool = True,
        extra: str | None = None,
        period: str | None = None,
    ):
        if period and (period not in PERIOD_COLUMNS or not partitioned):
            raise ValueError(f"The period of a partitioned store is one of {list(PERIOD_COLUMNS)}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.partitioned = partitioned
        self._declared = T.StructType.fromDDL(extra).fields if extra else []
        self._period = period

    def _stored(self, folder: str | None = None) -> tuple[list[T.StructField], str | None]:
        """Columns and period of the stored table. A table without a description was not written by
        this version: its files tell the columns (those of one folder, if that is given)."""
        text = read_text(self.spark, f"{self.path}/{DESCRIPTION}")
        try:
            found = json.loads(text or "{}")
            return T.StructType.fromJson(found["columns"]).fields, found["period"]
        except (ValueError, KeyError):
            period = self._period_of_folders()
            fields = stored_fields(self.spark, self.path, folder)
            return [field for field in fields if field.name != PERIOD_COLUMNS.get(period)], period

    def _period_of_folders(self) -> str | None:
        for ticker in subfolders(self.spark, self.path, "ticker=")[:1]:
            for period, name in PERIOD_COLUMNS.items():
                if subfolders(self.spark, ticker, f"{name}="):
                    return period
        return None

    def _describe(self, schema: T.StructType, period: str | None) -> None:
        """Before rows are added, so that their columns are known to every reader."""
        text = json.dumps({"columns": schema.jsonValue(), "period": period})
        if read_text(self.spark, f"{self.path}/{DESCRIPTION}") != text:
            write_text(self.spark, f"{self.path}/{DESCRIPTION}", text)

    def _layout(self, folder: str | None = None) -> tuple[T.StructType, str | None, bool]:
        """Columns and period of the table, and whether anything is stored."""
        stored, period = self._stored(folder)
        fields = {field.name: field for field in [*BARS_SCHEMA.fields, *self._declared]}
        for field in stored:
            fields.setdefault(field.name, field)
        return T.StructType(list(fields.values())), period if stored else self._period, bool(stored)

    def _target(self, bars: DataFrame, order: str | None = None) -> tuple[T.StructType, str | None]:
        """Columns and period of the table once `bars` are in it."""
        schema, period, known = self._layout()
        if not known and not self._declared:
            # An empty store takes its columns from the first batch.
            extra = [x for x in bars.schema.fields if x.name not in BAR_COLUMNS and x.name != order]
            schema = T.StructType([*schema.fields, *extra])
        if PERIOD_COLUMNS.get(period) in bars.columns:
            raise ValidationError(f"Columns that the store does not have: ['{PERIOD_COLUMNS[period]}']")
        return schema, period

    def _partitions(self, period: str | None) -> list[str]:
        return ["ticker", PERIOD_COLUMNS[period]] if period else ["ticker"]

    def bars(self, ticker: str | None = None, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
        """All bars, or those of one ticker, or of the closed interval from `start` to `end`.

        For one ticker only its folder is listed and read. A symbol that Spark
        escapes in folder names is found by pruning the partitions instead. Bounds prune the
        periods, if the table has any.
        """
        folder = None
        if self.partitioned and ticker is not None and re.fullmatch(PLAIN_SYMBOL, ticker):
            folder = f"ticker={ticker}"
        schema, period, _ = self._layout(folder)
        rows = read_table(self.spark, self.path, _with_period(schema, period), folder)
        if period:
            if start is not None:
                rows = rows.filter(F.col(PERIOD_COLUMNS[period]) >= period_of(moment(start), period))
            if end is not None:
                rows = rows.filter(F.col(PERIOD_COLUMNS[period]) <= period_of(moment(end), period))
        return in_window(for_ticker(rows, ticker), start, end).select(*quoted(schema.fieldNames()))

    def save(self, bars: DataFrame) -> str:
        """Partitioned: add `bars` as new files, so saving twice doubles the rows.
        Unpartitioned: replace the table. Returns the path."""
        with reporting():
            if self.partitioned:
                finish_replacements(self.spark, self.path)
                schema, period = self._target(bars)
                ready = _in_periods(conform(bars, schema, BAR_COLUMNS, KEY_COLUMNS), period)
                self._describe(schema, period)
                write_table(ready, self.path, self._partitions(period), ["timestamp"])
            else:
                # Staged first: `bars` may be a query over the table being replaced, whose
                # columns may be others.
                schema = T.StructType([*BARS_SCHEMA.fields, *[x for x in bars.schema.fields if x.name not in BAR_COLUMNS]])
                with staged(conform(bars, schema, BAR_COLUMNS, KEY_COLUMNS), "wide") as ready:
                    ready.write.mode("overwrite").parquet(self.path)
                self._describe(schema, None)
        return self.path

    def upsert(self, bars: DataFrame, order: str | None = None, validated: bool = False) -> int:
        """Insert or replace by (ticker, timestamp); returns the rows written.

        Of several rows with one key the one with the largest `order` value is
        kept; its values must not be null nor repeated in a key. Keys are compared as they are stored, so times
        in several spellings are one key. Without `order`, several rows are an error. Columns of the table that
        `bars` lack keep their values. `validated` tells that `bars` come from `load_bars_csv`: their keys
        are unique and they are stored already.
        """
        if not self.partitioned:
            raise ValueError("upsert needs a store partitioned by ticker")
        with reporting():
            schema, period = self._target(bars, order)
            # Missing keys are counted by the upsert itself.
            batch = conform(bars, ordered(schema, bars, order), BAR_COLUMNS, [])
            lacking = [name for name in schema.fieldNames() if name not in bars.columns]
            if validated:
                return self._upsert(batch, schema, period, lacking)
            with staged(batch, "batch") as batch:
                if not order:
                    require_unique(batch, KEY_COLUMNS)
                    return self._upsert(batch, schema, period, lacking)
                require_order(batch, KEY_COLUMNS, order)
                last = last_write(batch, KEY_COLUMNS, order).select(*quoted(schema.fieldNames()))
                with staged(last, "last") as last:
                    return self._upsert(last, schema, period, lacking)

    def _upsert(self, batch: DataFrame, schema: T.StructType, period: str | None, lacking: list[str]) -> int:
        self._describe(schema, period)
        rows = _in_periods(batch, period)
        return upsert_table(
            self.spark, self.path, rows, KEY_COLUMNS, "timestamp", self._partitions(period), ["timestamp"], lacking
        )

    def verify_integrity(self) -> StoreIntegrity:
        return check_store(self.spark, self.path, self.partitioned)


def period_of(timestamp: Column, period: str) -> Column:
    """The first day of the month or year."""
    return F.trunc(F.to_date(timestamp), period)


def _in_periods(bars: DataFrame, period: str | None) -> DataFrame:
    return bars.withColumn(PERIOD_COLUMNS[period], period_of(F.col("timestamp"), period)) if period else bars


def _with_period(schema: T.StructType, period: str | None) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PERIOD_COLUMNS[period], T.DateType())]) if period else schema
