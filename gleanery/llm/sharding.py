"""Sharding by a hierarchical weighted hash tree.

Each document descends from the region level over the rack level to a shard. A shard draws
-ln(u) / weight, with u a hash of the document's id and the shard's path; a rack's draw is the least
of its shards', a region's the least of its racks', and at each level the child with the least draw
wins. The least of exponential draws is one whose weight is the sum of theirs, so the share of every
node is its weight's share, and a node's draw changes only with the weights below it: changing a
weight moves documents only into or out of that subtree, at every level. So one more shard, wherever
it hangs, takes documents only into itself, from one shard on. As every draw on the way is that of
the shard it ends at, the descent is found in one pass over the shards.

Only DataFrame functions are used. Law: `key` (the id and the tree decide).

Defined results: a null text has no bytes, size 8 and CRC 0; null ids hash as the empty string
and share one shard; rows that repeat an id share a shard; an empty table gives an empty result;
other columns are ignored. Slots follow a hash of id, size and CRC, so that rows of one id lie apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import heavy_keys, stored

_HEX = 13  # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class Node:
    """A region or rack with children, whose weight is the sum of theirs, or a shard (a number)."""

    name: str
    weight: float = 0.0
    children: tuple["Node", ...] = ()
    shard: int | None = None


def shard_tree(shards: int, per_rack: int = 4, racks_per_region: int = 3) -> tuple[Node, ...]:
    """Regions for shards of equal weight, which fill racks and regions in order."""
    per_region = per_rack * racks_per_region
    regions = []
    for start in range(0, shards, per_region):
        racks = []
        for low in range(start, min(start + per_region, shards), per_rack):
            leaves = tuple(Node(f"s{k}", 1.0, shard=k) for k in range(low, min(low + per_rack, start + per_region, shards)))
            racks.append(Node(f"k{low // per_rack}", float(len(leaves)), leaves))
        regions.append(Node(f"r{start // per_region}", sum(k.weight for k in racks), tuple(racks)))
    return tuple(regions)


def _leaves(nodes: tuple[Node, ...], path: str = "") -> list[tuple[str, float, int]]:
    """Path, weight and number of each shard that has a weight."""
    found = []
    for n in nodes:
        if n.shard is None:
            found += _leaves(n.children, f"{path}{n.name}/")
        elif n.weight > 0:
            found.append((path + n.name, n.weight, n.shard))
    return found


def _hash(text: Column) -> Column:
    """52 bits of the MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("long")


def _uniform(key: Column, name: Column) -> Column:
    """In (0, 1), by the key and the name."""
    return (_hash(F.concat(key, F.lit(":"), name)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def place(key: Column, nodes: tuple[Node, ...]) -> Column:
    """The shard that a document's key descends to, over region and rack; of equal draws the lesser number."""
    leaves = F.array(*[F.struct(F.lit(path).alias("path"), F.lit(float(weight)).alias("weight"), F.lit(shard).alias("shard")) for path, weight, shard in _leaves(nodes)])
    draws = F.transform(leaves, lambda c: F.struct((-F.log(_uniform(key, c["path"])) / c["weight"]).alias("draw"), c["shard"].alias("shard")))
    return F.array_min(draws)["shard"]


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", tree: tuple[Node, ...] | None = None, grown: tuple[Node, ...] | None = None, rows_per_block: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number a shard's rows without gaps in the order of a hash. No shard is sorted in one
    task: the hash range is cut into blocks of about rows_per_block rows, a block with far more (of
    rows equal in id, size and CRC) is dealt out to parts, parts are counted, and a row's slot is the
    number of rows in earlier parts plus its rank in its own.
    """
    tree = tree or shard_tree(shards)
    grown = grown or shard_tree(shards + 1)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    size, crc = (F.octet_length(text) + 8).cast("long"), F.crc32(text.cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), _hash(F.concat_ws(":", key, size.cast("string"), crc.cast("string"))).alias("turn"),
        place(key, tree).cast("int").alias("shard"), place(key, grown).cast("int").alias("grown_shard"), F.monotonically_increasing_id().alias("row"),
    )
    # Written, as blocks are counted and then numbered: texts are read once.
    rows = stored(rows, "placed")
    total = rows.count()
    blocks = max(1, -(-total // (rows_per_block * max(1, len(_leaves(tree))))))
    rows = rows.withColumn("block", F.col("shard") * F.lit(blocks).cast("long") + F.floor(F.col("turn") / float(1 << 52) * blocks).cast("long"))
    heavy = heavy_keys(rows.groupBy("block").agg(F.count("*").alias("n")), "block", "n", total, least=4 * rows_per_block)
    rows = rows.join(F.broadcast(heavy), "block", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("deals")), F.lit(0)).cast("int"))
    counts = rows.groupBy("shard", "block", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "block", "part").orderBy("turn", "doc_id", "size", "text_crc32", "row")
    ranked = rows.withColumn("rank", F.row_number().over(within))
    return ranked.join(starts.hint("merge"), ["shard", "block", "part"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard")
