"""Fixity audit of archive replicas with Merkle trees.

A leaf is the hash of the records at one offset of an archive file; above it are nodes over
offset ranges of `RANGE_BYTES`, then over `FAN_OUT` neighbouring nodes each, up to one root
per archive file. Two replicas are compared at their roots; below that only the children of
nodes that differ are compared, down to the records.

Nodes are keyed by archive and range, so an archive file that holds a third of all records is
spread like any other. A node hashes at most FAN_OUT children, or the offsets of one range.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.session import stage

RANGE_BYTES = 1 << 16
FAN_OUT = 32


def warc_record(url: Column, payload: Column) -> Column:
    """The bytes of a WARC response record; null parts are empty."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def _slots(records: DataFrame) -> DataFrame:
    """One leaf per archive and offset. Several records at one offset are folded by sums over
    their digests, whatever their order and number, before any row is shuffled."""
    digest = F.coalesce("digest", F.lit(""))
    own = F.sha2(F.concat_ws("|", F.coalesce("length", F.lit(-1)).cast("string"), digest), 256)
    parts = [F.conv(F.substring(own, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    folded = records.groupBy(F.coalesce("archive", F.lit(-1)).alias("archive"), F.coalesce("offset", F.lit(-1)).alias("offset")).agg(
        F.count("*").alias("records"),
        F.min("record_id").alias("record_id"),
        F.sum("length").alias("length"),
        *[F.sum(part).alias(f"part{i}") for i, part in enumerate(parts)],
    )
    leaf = F.concat_ws("|", F.col("offset").cast("string"), "records", *[F.col(f"part{i}").cast("string") for i in range(4)])
    return folded.select("archive", F.col("offset").alias("node"), "records", "record_id", "length", F.sha2(leaf, 256).alias("digest"))


def _above(nodes: DataFrame, width: int) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("node", "digest")))
    text = F.concat_ws("|", F.transform(children, lambda c: F.concat(c["node"].cast("string"), F.lit(":"), c["digest"])))
    grouped = nodes.groupBy("archive", F.floor(F.col("node") / width).alias("parent")).agg(F.sha2(text, 256).alias("digest"))
    return grouped.withColumnRenamed("parent", "node")


def merkle_tree(records: DataFrame, depth: int, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels from the leaves to the roots (node 0 of `depth` levels above the ranges), each a
    written table (archive, node, digest; leaves also record_id, records, length)."""
    levels = [stage(_slots(records), "merkle-leaves")]
    levels.append(stage(_above(levels[0], range_bytes), "merkle-ranges"))
    for _ in range(depth):
        levels.append(stage(_above(levels[-1], fan_out), "merkle-nodes"))
    return levels


def tree_depth(replicas: list[DataFrame], range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> int:
    """Levels above the ranges until one node holds all."""
    tops = [replica.agg(F.coalesce(F.max("offset"), F.lit(0))).first()[0] for replica in replicas]
    nodes, depth = max(tops) // range_bytes + 1, 0
    while nodes > 1:
        nodes, depth = -(-nodes // fan_out), depth + 1
    return depth


def audit_replicas(
    original: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT
) -> DataFrame:
    """The places at which the replicas differ: archive, offset, record_id, length, kind.

    Both tables have archive, offset, length, digest and record_id (all integers but the
    digest). kind is `altered` (records at that offset in both, not the same), `missing` (none
    in the replica) or `extra` (none in the original). record_id is the smallest of the records
    there and length the sum of their lengths, of the original unless the kind is extra. A null
    archive or offset counts as -1, a null digest as empty. Repeated records are told from
    single ones. Other columns are not read. Equal replicas, empty ones included, give no row.
    """
    wanted = ["archive", "offset", "length", "digest", "record_id"]
    tables = [original.select(*wanted), replica.select(*wanted)]
    depth = tree_depth(tables, range_bytes, fan_out)
    left, right = (merkle_tree(table, depth, range_bytes, fan_out) for table in tables)
    differing = None
    for level in range(depth + 1, -1, -1):
        # Nodes over offset -1 have numbers below 0; a root there is one of its own.
        width = None if differing is None else (range_bytes if level == 0 else fan_out)
        sides = []
        for side, name in ((left[level], "a"), (right[level], "b")):
            if differing is not None:
                parent = F.floor(F.col("node") / width)
                chosen = differing.select(F.col("archive").alias("_archive"), F.col("node").alias("_node"))
                side = side.join(chosen, (F.col("archive") == F.col("_archive")) & (parent == F.col("_node")), "left_semi")
            sides.append(side.select("archive", "node", F.struct(*[c for c in side.columns if c not in ("archive", "node")]).alias(name)))
        both = sides[0].join(sides[1], ["archive", "node"], "full").filter(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        differing = stage(both, "merkle-differences")
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
    return differing.select(
        "archive",
        F.col("node").alias("offset"),
        F.coalesce("a.record_id", "b.record_id").alias("record_id"),
        F.coalesce("a.length", "b.length").alias("length"),
        kind.alias("kind"),
    )
