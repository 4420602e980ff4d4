"""Exact membership by a cascade of Bloom filters, and URL rules.

The keys that may ever be asked for are known: the universe. Level 0 of a cascade encodes
the listed keys, level 1 the other keys of the universe that level 0 lets through by
mistake, level 2 the listed keys that level 1 lets through, and so on until a level lets
through no wrong key. A key is listed if the first level that lacks it is an odd one, or if
no level lacks it and their number is odd. For keys of the universe that is exact.

Keys are dealt out by hash to buckets of about `BUCKET_KEYS` keys, each with a cascade of its
own, so a cascade is built in one small task whatever the size of the universe.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.llm.textbytes import mix
from candlekit.session import stage

BUCKET_KEYS = 20_000
#: Largest cascade (all buckets) that is sent to the executors.
CASCADE_BYTES = 64 << 20
LEVELS = 64

#: Rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, hashes: np.ndarray, size: np.ndarray):
    """Bits of each key in the filter of a level, and whether each is in use."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
    a, b = mix(h1 ^ salt), mix(h2 + salt) | np.uint64(1)
    for i in range(int(hashes.max(initial=0))):
        yield ((a + np.uint64(i) * b) % size.astype(np.uint64)).astype(np.int64), i < hashes


def _cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(size in bits, hashes, bits) of every level."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels = []
    rate = min(0.5, len(inside) * 0.5**0.5 / max(1, len(outside)))
    while len(inside):
        if len(levels) == LEVELS:
            raise ValueError("A listed and another key have the same 128-bit hash")
        hashes = max(1, int(np.ceil(-np.log2(max(rate, 1e-9)))))
        size = 8 * int(np.ceil(len(inside) * hashes / np.log(2) / 8) + 1)
        bits = np.zeros(size, bool)
        shape = np.full(len(inside), hashes), np.full(len(inside), size)
        for at, _ in _positions(h1[inside], h2[inside], len(levels), *shape):
            bits[at] = True
        through = np.ones(len(outside), bool)
        for at, _ in _positions(h1[outside], h2[outside], len(levels), np.full(len(outside), hashes), np.full(len(outside), size)):
            through &= bits[at]
        levels.append((size, hashes, np.packbits(bits).tobytes()))
        inside, outside, rate = outside[through], inside, 0.5
    return levels


def _build(group: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (group[name].to_numpy(np.int64).view(np.uint64) for name in ("h1", "h2"))
    levels = _cascade(h1, h2, group["listed"].to_numpy(bool))
    rows = [(group["bucket"].iloc[0], i, *level) for i, level in enumerate(levels)]
    return pd.DataFrame(rows, columns=["bucket", "level", "size", "hashes", "bits"])


@dataclass
class Cascades:
    """All levels of some buckets; `size`, `hashes` and `start` by bucket and level (0: no such level)."""

    size: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, int, int, int, bytes]], buckets: int) -> "Cascades":
        depth = max((row[1] for row in rows), default=0) + 1
        size, hashes, start = (np.zeros((buckets, depth), np.int64) for _ in range(3))
        at = 0
        for bucket, level, bits, count, packed in rows:
            size[bucket, level], hashes[bucket, level], start[bucket, level] = bits, count, at
            at += len(packed) * 8
        return Cascades(size, hashes, start, np.frombuffer(b"".join(row[4] for row in rows) or b"\0", np.uint8))

    def listed(self, bucket: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        answer = np.zeros(len(bucket), bool)
        going = np.arange(len(bucket))
        for level in range(self.size.shape[1] + 1):
            # A level that a cascade does not have lacks every key.
            has = self.size[bucket[going], level] > 0 if level < self.size.shape[1] else np.zeros(len(going), bool)
            answer[going[~has]] = level % 2 == 1
            going = going[has]
            if not len(going):
                break
            own = bucket[going]
            through = np.ones(len(going), bool)
            for at, used in _positions(h1[going], h2[going], level, self.hashes[own, level], self.size[own, level]):
                bit = self.start[own, level] + at
                through &= ~used | ((self.bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)
            answer[going[~through]] = level % 2 == 1
            going = going[through]
        return answer


def _hashed(key: Column, buckets: int) -> list[Column]:
    h1, h2 = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    return [F.pmod(h1, F.lit(buckets)).alias("bucket"), h1.alias("h1"), h2.alias("h2")]


def build_cascades(universe: DataFrame, listed: DataFrame, key: str, buckets: int) -> DataFrame:
    """(bucket, level, size, hashes, bits): the cascades for the keys of both tables."""
    flagged = universe.select(F.col(key), F.lit(False).alias("listed")).unionByName(
        listed.select(F.col(key), F.lit(True).alias("listed"))
    )
    keys = flagged.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("listed").alias("listed"))
    built = keys.select(*_hashed(F.col(key), buckets), "listed").groupBy("bucket")
    return stage(
        built.applyInPandas(_build, "bucket BIGINT, level INT, size BIGINT, hashes INT, bits BINARY"), "bloom-cascades"
    )


def with_membership(
    rows: DataFrame, listed: DataFrame, key: str, column: str = "listed", limit: int = CASCADE_BYTES
) -> DataFrame:
    """`rows` with a boolean column: is the key listed?

    The universe is all keys of `rows` and `listed`. A null key is not listed. The cascades
    are sent to the executors while they are smaller than `limit` bytes; beyond that the
    distinct keys meet their cascade bucket by bucket and the answers are joined to the
    rows. Other columns of `rows` are carried along, a column of the result's name is
    replaced. Repeated keys are allowed in both tables; either may be empty.
    """
    spark = rows.sparkSession
    count = rows.select(key).unionByName(listed.select(key)).agg(F.approx_count_distinct(key)).first()[0]
    buckets = max(1, -(-count // BUCKET_KEYS))
    cascades = build_cascades(rows, listed, key, buckets)
    size = cascades.agg(F.coalesce(F.sum(F.octet_length("bits") + 32), F.lit(0))).first()[0]
    names = ["bucket", "level", "size", "hashes", "bits"]
    if size <= limit:
        shared = spark.sparkContext.broadcast(Cascades.of([tuple(row) for row in cascades.select(*names).collect()], buckets))

        @F.pandas_udf("boolean")
        def member(bucket: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.Series:
            hashes = (x.to_numpy(np.int64).view(np.uint64) for x in (h1, h2))
            return pd.Series(shared.value.listed(bucket.to_numpy(np.int64), *hashes))

        return rows.withColumn(column, F.col(key).isNotNull() & member(*_hashed(F.col(key), buckets)))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(0, *row) for row in zip(*(right.column(name).to_pylist() for name in names[1:]))]
        hashes = (left.column(name).to_numpy().view(np.uint64) for name in ("h1", "h2"))
        answer = Cascades.of(found, 1).listed(np.zeros(left.num_rows, np.int64), *hashes)
        return left.append_column("_listed", pa.array(answer)).select(["_key", "_listed"])

    keys = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    asked = keys.select("_key", *_hashed(F.col("_key"), buckets))
    answers = asked.groupBy("bucket").cogroup(cascades.groupBy("bucket")).applyInArrow(meet, "_key STRING, _listed BOOLEAN")
    joined = rows.drop(column).join(answers, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_listed", F.lit(False))).drop("_key", "_listed")


def url_host(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does. A rule fits its host
    and all subdomains, if the path starts with the rule's."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda rule: len(rule[0] + rule[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, limit: int = CASCADE_BYTES) -> DataFrame:
    """`pages` with host, path, rule, verdict and listed.

    The verdict is that of the longest rule that fits; else block if the page's address
    (host and path) is among the addresses of `listed` (column address), allow if not. A url
    that is null or has no `://` has an empty host and path; its address is empty. Columns of
    the result's names are replaced, others are carried along. Empty tables are allowed.
    """
    url = F.col("url")
    parsed = pages.withColumns({"host": url_host(url), "path": url_path(url)})
    parsed = parsed.withColumn("_address", F.concat("host", "path"))
    member = with_membership(parsed, listed.select(F.col("address").alias("_address")), "_address", "listed", limit)
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return member.withColumns({"rule": rule["rule"], "verdict": F.coalesce(rule["verdict"], by_list)}).drop("_address")
