"""Sharding by a hierarchical weighted hash tree.

A row descends from region to rack to shard. At each level every child draws -ln(u) / weight,
u from a hash of the row's key and the child's path, and the smallest draw wins, so a child
gets its weight's share, and a change of weights moves rows only between subtrees whose
weights change. A shard that is added as a region of its own takes rows only into itself.

Edge cases: a null doc_id is the key ''; equal keys share a shard; a null text has size 1 and
crc32 0; repeated rows each get a slot; an empty table gives no rows; only doc_id and text
are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import durable, table


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: its name is unique among its siblings; a shard has a number and no children."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight

    def shards(self) -> list[int]:
        return [s for c in self.children for s in c.shards()] if self.children else [self.shard]


def balanced(regions: int = 2, racks: int = 2, shards: int = 4) -> Node:
    """A tree of shards 0, 1, ... of equal weight."""
    number = iter(range(regions * racks * shards))
    return Node("root", tuple(Node(f"region{r}", tuple(Node(f"rack{k}", tuple(Node(f"shard{n}", shard=n) for n in (next(number) for _ in range(shards)))) for k in range(racks))) for r in range(regions)))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one shard more, in a region and rack of its own."""
    n = max(tree.shards()) + 1
    rack = Node("rack0", (Node(f"shard{n}", shard=n, own_weight=weight),))
    return Node(tree.name, (*tree.children, Node(f"region-of-{n}", (rack,))), own_weight=tree.own_weight)


def _draw(key: Column, path: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, tree: Node, path: str = "") -> Column:
    """The shard that a key descends to; only the draws on its way are computed."""
    if not tree.children:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.weight > 0]
    if len(live) == 1:
        return shard_of(key, live[0], f"{path}/{live[0].name}")
    best = F.array_min(F.array(*[F.struct(_draw(key, f"{path}/{c.name}", c.weight).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(live)]))["child"]
    below = F.array(*[F.lit(i) for i in range(len(live))]) if all(not c.children for c in live) else None
    if below is not None:
        return F.element_at(F.array(*[F.lit(c.shard) for c in live]), best + 1)
    out = F.when(best == 0, shard_of(key, live[0], f"{path}/{live[0].name}"))
    for i, c in enumerate(live[1:], 1):
        out = out.when(best == i, shard_of(key, c, f"{path}/{c.name}"))
    return out


def assign(docs: DataFrame, tree: Node, larger: Node | None = None, run_rows: int = 1000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row.

    Slots count from 0 in each shard. They are ranks by hash within runs of about run_rows
    rows, after the rows of the runs before, so no task gets a whole shard.
    """
    larger = larger or grown(tree)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"), shard_of(key, larger).cast("int").alias("grown_shard"),
    )
    rows = durable(rows, "shards")
    n_runs = max(1, rows.count() // (run_rows * len(tree.shards())))
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "text_crc32", "size")).withColumn("run", F.pmod("draw", F.lit(n_runs)))
    lengths = rows.groupBy("shard", "run").agg(F.count("*").alias("m"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.select("shard", "run", F.coalesce(F.sum("m").over(before), F.lit(0).cast("long")).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "run").orderBy("draw", "doc_id"))
    out = rows.withColumn("place", place).join(lengths, ["shard", "run"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("place") - 1 + F.col("before")).cast("long").alias("slot"), "grown_shard")


def op6_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"), balanced())
