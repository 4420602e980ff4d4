"""Consistent hashing with virtual nodes and bounded loads.

Every shard owns many points of a ring; a row belongs to the first point at or
after its own position. Rows arrive in ring order. A shard that is full passes
the rows that follow clockwise to the next shard with room.

Which rows are passed on depends only on the number of rows per arc between two
points: within an arc rows arrive in order of position. So one aggregation gives
the counts per arc (at most shards * points numbers, whatever the input), the
walk is done on these counts, and its outcome is a small table of segments: of
an arc, ranks `from` to `to` go to a shard, starting at a slot. A row finds its
segment by its rank in the arc.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RING = 1 << 32
CELLS = 1 << 12
SEGMENTS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("_arc", "_from", "_to", "_shard", "_slot")]
)


def ring_points(shards: int, points: int) -> list[tuple[int, int]]:
    """(position, shard), sorted. A shard's points do not depend on the other shards."""
    placed = {}
    for shard in range(shards):
        for point in range(points):
            digest = hashlib.sha256(f"shard {shard} point {point}".encode()).digest()
            placed.setdefault(int.from_bytes(digest[:4], "big"), shard)
    return sorted(placed.items())


def walk(owners: list[int], counts: list[int], capacities: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, from, to, shard, first slot) of the rows that arrive arc by arc."""
    used = [0] * len(capacities)
    segments = []
    for arc, count in enumerate(counts):
        rank, at = 0, arc
        while rank < count:
            shard = owners[at % len(owners)]
            taken = min(count - rank, capacities[shard] - used[shard])
            if taken:
                segments.append((arc, rank, rank + taken, shard, used[shard]))
                used[shard] += taken
                rank += taken
            at += 1
    return segments


def even_capacities(rows: int, shards: int) -> list[int]:
    """Capacities that differ by one at most and hold exactly `rows`."""
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def _arcs(spark: SparkSession, positions: list[int]) -> DataFrame:
    """The ring cut into cells of equal width: the arcs (from, to) that meet each cell."""
    rows, arc = [], 0
    for cell in range(CELLS):
        low, high = cell * RING // CELLS, (cell + 1) * RING // CELLS
        while arc < len(positions) and positions[arc] < low:
            arc += 1
        at = arc
        while low < high:
            # Past the last point the ring begins anew.
            end = min(high, positions[at] + 1) if at < len(positions) else high
            rows.append((cell, low, end, at % len(positions)))
            low, at = end, at + 1
    return spark.createDataFrame(rows, "_cell BIGINT, _low BIGINT, _high BIGINT, _arc BIGINT")


def shard_rows(docs: DataFrame, shards: int = 8, points: int = 512, key: str = "doc_id", tie: str = "text") -> DataFrame:
    """`docs` with the columns shard (from 0) and slot (gapless from 0 in its shard).

    The counts of the shards differ by one at most. A row's position is the hash of
    `key`; rows without a key are placed by `tie`. Rows at the same position are
    ordered by `key`, then by the hash of `tie`; rows equal in both are
    interchangeable. Other columns are carried along, whatever their names; columns
    called shard or slot are replaced. An empty table gives an empty result. `docs`
    is read twice and must give the same rows each time.
    """
    ring = ring_points(shards, points)
    owners = [owner for _, owner in ring]
    # Both tables that are broadcast have some thousand rows whatever the input:
    # at most one per cell and arc, or per arc and shard.
    arcs = _arcs(docs.sparkSession, [position for position, _ in ring])

    mark = F.xxhash64(F.col(tie))
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("without key "), mark.cast("string")))
    position = F.pmod(F.xxhash64(name), F.lit(RING))
    here = (F.col("_position") >= F.col("_low")) & (F.col("_position") < F.col("_high"))

    def placed(carried: list[str]) -> DataFrame:
        rows = docs.select(
            F.struct(F.lit(0).alias("_none"), *[F.col(f"`{column}`") for column in carried]).alias("_row"),
            position.alias("_position"),
            F.col(key).alias("_key"),
            mark.alias("_mark"),
        ).withColumn("_cell", F.floor(F.col("_position") / (RING // CELLS)))
        return rows.join(F.broadcast(arcs), "_cell").filter(here)

    counts = [0] * len(ring)
    for row in placed([]).groupBy("_arc").count().collect():
        counts[row["_arc"]] = row["count"]
    segments = walk(owners, counts, even_capacities(sum(counts), shards))
    table = docs.sparkSession.createDataFrame(segments, SEGMENTS)

    carried = [column for column in docs.columns if column not in ("shard", "slot")]
    order = Window.partitionBy("_arc").orderBy("_position", "_key", "_mark")
    ranked = placed(carried).withColumn("_rank", F.row_number().over(order) - 1)
    inside = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return (
        ranked.join(F.broadcast(table), "_arc")
        .filter(inside)
        .select(
            *[F.col(f"_row.`{column}`") for column in carried],
            F.col("_shard").cast("int").alias("shard"),
            (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"),
        )
    )
