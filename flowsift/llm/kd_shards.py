"""Sharding by a k-d tree over document metadata.

A node that is to become k shards is split along the metadata dimension that is widest in it, at
the weighted quantile that gives floor(k / 2) shards to the left; weights are bytes. Quantiles are
found for all nodes of a level at once by counting bytes in ranges of values and narrowing the
range, so no node's rows are gathered. Rows that share a value are told apart by id, by the other
columns, and rows alike by a number that each got when it was landed, so one source or one row
with a third of all rows is split like any other. The tree is one
nested conditional expression. A row's slot is its bucket's first slot plus its place in the
bucket; buckets are of bounded size.

Cases: null text weighs 1 byte, as an empty one; very long texts weigh what they are; null
metadata sorts before all other; rows alike in all of this are divided like others, and which of
them goes where touches no result; an empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.scratch import land

RANGES = 2048
#: Rows of a range that are compared one by one on the driver.
FEW_ROWS = 4_000
BUCKET_ROWS = 2_000

#: Metadata dimensions as whole numbers; the widest is measured against the whole table's width.
DIMENSIONS = ("d_size", "d_source", "d_lang", "d_id")
#: What orders rows that share the dimension's value.
TIES = ("d_id", "text_crc32", "size", "d_row")


@dataclass
class Node:
    """A node that becomes `shards` shards from `first` on. Inner nodes hold a splitting key; rows
    with the key itself go left if `with_key`."""

    first: int
    shards: int
    keys: list[str] = field(default_factory=list)
    at: tuple[int, ...] | None = None
    with_key: bool = True
    left: "Node | None" = None
    right: "Node | None" = None
    # While the key is searched: values found so far, the range of the next, bytes to its left.
    found: list[int] = field(default_factory=list)
    low: int = 0
    high: int = 0
    goal: float = 0.0
    total: int = 0
    before: int = 0

    def settle(self, key: tuple[int, ...], size: int) -> None:
        """The goal is reached at this key, which holds `size` bytes: they go where they leave the
        halves more even, and neither half empty."""
        self.at = key
        nearer = size - self.goal <= self.goal
        self.with_key = not self.before or (nearer and self.before + size < self.total)

    def passed(self, size: int) -> None:
        self.before += size
        self.goal -= size

    def active(self) -> Column:
        """Rows of this node that may still hold the splitting key."""
        out = F.col("node") == self.first
        for k, v in zip(self.keys, self.found):
            out = out & (F.col(k) == v)
        if len(self.found) < len(self.keys):
            out = out & F.col(self.keys[len(self.found)]).between(self.low, self.high)
        return out


def metadata(docs: DataFrame) -> DataFrame:
    """Size, hash and metadata of each document, all whole numbers but the id itself."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def code(name: str) -> Column:
        if name not in docs.columns:
            return F.lit(-1).cast("long")
        return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(-1)).cast("long")

    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        code("source").alias("d_source"), code("lang").alias("d_lang"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 62))).alias("d_id"),
        F.monotonically_increasing_id().alias("d_row"),
    ).withColumn("d_size", F.col("size"))


def _node_of(tree: Node) -> Column:
    if tree.left is None or tree.right is None:
        return F.lit(tree.first)
    below = F.lit(tree.with_key)
    for k, v in reversed(list(zip(tree.keys, tree.at))):
        below = (F.col(k) < v) | ((F.col(k) == v) & below)
    return F.when(below, _node_of(tree.left)).otherwise(_node_of(tree.right))


def _choose(which: list[Node], value) -> Column:
    out = None
    for n in which:
        out = F.when(F.col("node") == n.first, value(n)) if out is None else out.when(
            F.col("node") == n.first, value(n))
    return out


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _settle(node: Node, rows: list) -> None:
    """The first key that reaches the goal's bytes, from the rows in question."""
    sizes: dict[tuple, int] = {}
    for r in rows:
        key = tuple(r[k] for k in node.keys)
        sizes[key] = sizes.get(key, 0) + r["size"]
    last = max(sizes)
    for key, size in sorted(sizes.items()):
        if size >= node.goal or key == last:
            return node.settle(key, size)
        node.passed(size)


def _search(rows: DataFrame, nodes: list[Node]) -> None:
    """Splitting keys of all nodes of a level; each pass is one aggregate of bounded output."""
    open_ = list(nodes)
    while open_:
        width = {n.first: max(1, -(-(n.high - n.low + 1) // RANGES)) for n in open_}
        part = _choose(open_, lambda n: F.floor(
            (F.col(n.keys[len(n.found)]) - n.low) / width[n.first]).cast("int"))
        following = _choose(open_, lambda n: F.col(n.keys[min(len(n.found) + 1, len(n.keys) - 1)]))
        counts = rows.where(_any([n.active() for n in open_])).groupBy("node", part.alias("part")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
            F.min(following).alias("lo"), F.max(following).alias("hi")).collect()
        few, wide = [], []
        for n in open_:
            own = sorted((r for r in counts if r["node"] == n.first), key=lambda r: r["part"])
            for r in own:
                if r["bytes"] >= n.goal or r is own[-1]:
                    break
                n.passed(r["bytes"])
            n.low += r["part"] * width[n.first]
            n.high = min(n.high, n.low + width[n.first] - 1)
            if r["n"] <= FEW_ROWS:
                few.append(n)
            elif n.low < n.high:
                wide.append(n)
            else:  # one value with many rows: go on with the next column
                n.found.append(n.low)
                n.low, n.high = r["lo"], r["hi"]
                if len(n.found) == len(n.keys):
                    n.settle(tuple(n.found), r["bytes"])
                else:
                    wide.append(n)
        if few:
            got = rows.where(_any([n.active() for n in few])).select(
                "node", *dict.fromkeys([*DIMENSIONS, *TIES])).collect()
            for n in few:
                _settle(n, [r for r in got if r["node"] == n.first])
        open_ = wide


def build(rows: DataFrame, shards: int) -> tuple[Node, int]:
    """The tree and the number of rows. Every level costs a few aggregates."""
    tree, whole, count = Node(0, shards), None, 0
    level = [tree]
    while level:
        table = rows.withColumn("node", _node_of(tree))
        stats = {r["node"]: r for r in table.where(_any([F.col("node") == n.first for n in level])).groupBy(
            "node").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *[
                f(d).alias(f"{d}_{k}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))]).collect()}
        if whole is None and stats:
            r = stats[0]
            count, whole = r["n"], {d: max(1, r[f"{d}_hi"] - r[f"{d}_lo"]) for d in DIMENSIONS}
        level = [n for n in level if n.shards > 1 and n.first in stats]
        for n in level:
            r = stats[n.first]
            widest = max(DIMENSIONS, key=lambda d: (r[f"{d}_hi"] - r[f"{d}_lo"]) / whole[d])
            n.keys = list(dict.fromkeys([widest, *TIES]))
            n.low, n.high = r[f"{widest}_lo"], r[f"{widest}_hi"]
            n.total = r["bytes"]
            n.goal = n.total * (n.shards // 2) / n.shards
        if level:
            _search(table, level)
        for n in level:
            half = n.shards // 2
            n.left, n.right = Node(n.first, half), Node(n.first + half, n.shards - half)
        level = [c for n in level for c in (n.left, n.right) if c.shards > 1]
    return tree, count


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """Number of shards whose mean size is at most the target."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // target_bytes))


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: near equal bytes in every shard.
    Give the number of shards or the bytes a shard should have."""
    rows = land(metadata(docs), "metadata")
    tree, count = build(rows, shards or shards_for(rows, target_bytes))
    n_leaves = tree.shards
    buckets = max(1, count // (n_leaves * BUCKET_ROWS))
    dealt = rows.withColumn("shard", _node_of(tree)).withColumn(
        "bucket", F.pmod(F.xxhash64("d_row"), F.lit(buckets)).cast("int"))
    # Bytes decide shards, so shards may differ in rows; a bucket has some BUCKET_ROWS of them.
    sizes = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size", "d_row")
    return dealt.withColumn("place", F.row_number().over(own)).join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
