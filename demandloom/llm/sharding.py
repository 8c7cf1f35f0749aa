"""Sharding by a k-d tree over the documents' metadata.

Every document is a point: its size, its language and its source as small integers. The root holds
all points and all shards. A node with k shards is split along its widest dimension (the spread
of its values against their spread in the whole table), at the point where the running bytes
reach floor(k / 2) / k of the node's bytes: a weighted median, or the next best fraction where k
is odd. Leaves have one shard, so every shard gets the bytes of the table over the number of
shards, up to half a unit a level.

What a split may not cut are units: documents of equal text share their coordinates and are one
unit, so a group of copies lands in one shard. A group of more than ``1 / PIECES`` of a shard's
bytes, which may be a third of the table, is dealt into pieces below that by a hash of its rows.

A split is found by histograms: bytes by value, then, where the split falls inside one value, bytes
by ever shorter ranges of the text's hash. A round over one level of the tree is one aggregation that
gives at most BINS rows a node to the driver, however many documents there are; no sort of the points.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.common import text_code, written

#: A text is whole within a shard unless all its copies hold more than this part of a shard.
PIECES = 50
#: Ranges of a hash that one round tells apart.
BINS = 1024
#: Documents that are numbered in one task, on average.
NUMBERED_AT_ONCE = 65_536
#: Bits of ``text_code``, which orders points.
HASH_BITS = 60
DIMENSIONS = ("c0", "c1", "c2")


def _category(c: Column) -> Column:
    """0 to 255 by hash, and -1 for null: equal values stay together, order means nothing."""
    return F.coalesce(F.conv(F.substring(F.md5(c.cast("string")), 1, 2), 16, 10).cast("int"), F.lit(-1))


def _magnitude() -> Column:
    """Sixteen steps a doubling of ``size``, in integers; sizes are 16 at least."""
    return F.expr("length(bin(size)) * 16 + cast(shiftright(size, length(bin(size)) - 5) & 15 as int)")


@dataclass
class _Node:
    """Shards ``first`` to ``first + shards - 1``; a split sends (value, hash, piece) below ``cut`` to the left."""

    first: int
    shards: int
    dimension: int = 0
    cut: tuple[int, int, int] | None = None
    below: list[_Node] = field(default_factory=list)

    def split(self) -> list[_Node]:
        half = self.shards // 2
        self.below = [_Node(self.first, half), _Node(self.first + half, self.shards - half)]
        return self.below


def _place(node: _Node) -> Column:
    """The first shard of the lowest node that a point has reached."""
    if not node.below:
        return F.lit(node.first)
    left, right = (_place(n) for n in node.below)
    if node.cut is None:
        return right
    value, code, piece = node.cut
    c = F.col(DIMENSIONS[node.dimension])
    inside = (F.col("code") < code) | ((F.col("code") == code) & (F.col("piece") < piece))
    return F.when((c < value) | ((c == value) & inside), left).otherwise(right)


@dataclass
class _Search:
    """Where a node's split is looked for: among values, then hashes of a value, then pieces of a text."""

    node: _Node
    total: int
    before: int = 0
    stage: int = 0
    value: int = 0
    low: int = 0
    width: int = 1

    def row(self) -> str:
        numbers = (self.node.first, self.node.dimension, self.stage, self.value, self.low, self.width)
        return f"({', '.join(f'{x}L' for x in numbers)})"

    def narrow(self, bins: list) -> bool:
        """Take one round's (bin, bytes, least and greatest hash, units) in order; whether the split is found."""
        k, half = self.node.shards, self.node.shards // 2
        for b in bins:
            if (self.before + b.bytes) * k <= self.total * half:
                self.before += b.bytes
                continue
            if self.before * k >= self.total * half:
                return self._found(b.bin, b.least)
            if self.stage == 0:
                self.value = b.bin
                self.low, self.width, self.stage = 0, (1 << HASH_BITS) // BINS, 1
            elif self.stage == 1 and b.least < b.greatest:
                self.low, self.width = self.low + b.bin * self.width, max(1, self.width // BINS)
            elif self.stage == 1 and b.pieces > 1:
                self.low, self.stage = b.least, 2
            else:  # one unit: it goes to the side of its middle
                left = (2 * self.before + b.bytes) * k <= 2 * self.total * half
                return self._found(b.bin, b.least, after=left)
            return False
        raise AssertionError("the last bin reaches the total")

    def _found(self, key: int, code: int, after: bool = False) -> bool:
        """The split lies before (or right after) the unit or the bin that starts there."""
        if self.stage == 0:
            self.node.cut = (key, -1, 0)
        elif self.stage == 1:
            self.node.cut = (self.value, code + after, 0)
        else:
            self.node.cut = (self.value, self.low, key + after)
        return True


def _round(points: DataFrame, root: _Node, searches: list[_Search]) -> dict[int, list]:
    """One histogram for every open search, by node."""
    state = F.broadcast(  # a row a node of one level, fewer than there are shards
        points.sparkSession.sql(
            f"select * from values {', '.join(s.row() for s in searches)} as s(node, dimension, stage, value, low, width)"
        )
    )
    own = F.coalesce(*(F.when(F.col("dimension") == d, F.col(c)) for d, c in enumerate(DIMENSIONS)))
    offset = F.col("code") - F.col("low")
    open_rows = (
        # sizes are never negative: at the root this keeps the join one of equal keys
        points.withColumn("node", F.when(F.col("size") < 0, -1).otherwise(_place(root)).cast("long"))
        .join(state, "node")
        .withColumn("own", own)
        .filter(
            (F.col("stage") == 0)
            | ((F.col("own") == F.col("value")) & F.when(F.col("stage") == 1, (offset >= 0) & (offset < F.col("width") * BINS)).otherwise(offset == 0))
        )
    )
    key = F.when(F.col("stage") == 0, F.col("own")).when(F.col("stage") == 1, F.expr("(code - low) div width")).otherwise(F.col("piece"))
    found = (
        open_rows.groupBy("node", key.cast("long").alias("bin"))
        .agg(
            F.sum("size").alias("bytes"), F.min("code").alias("least"), F.max("code").alias("greatest"),
            F.max("pieces").alias("pieces"),
        )
        .collect()
    )
    by_node: dict[int, list] = {}
    for b in sorted(found, key=lambda r: (r.node, r.bin)):
        by_node.setdefault(b.node, []).append(b)
    return by_node


def _grow(points: DataFrame, shards: int) -> _Node:
    """The tree over written points: code, piece, pieces, size and the dimensions."""
    root = _Node(0, shards)
    level, spread = [root], None
    while any(n.shards > 1 for n in level):
        ends = [f(c).alias(f"{c}_{f.__name__}") for c in DIMENSIONS for f in (F.min, F.max)]
        seen = {
            r.node: r
            for r in points.groupBy(_place(root).cast("long").alias("node")).agg(F.sum("size").alias("bytes"), *ends).collect()
        }
        searches = []
        for node in (n for n in level if n.shards > 1 and n.first in seen):
            r = seen[node.first]
            widths = [r[f"{c}_max"] - r[f"{c}_min"] for c in DIMENSIONS]
            spread = spread or [max(1, w) for w in widths]
            parts = [w / s for w, s in zip(widths, spread)]
            node.dimension = parts.index(max(parts))
            searches.append(_Search(node, r.bytes))
        while searches:
            bins = _round(points, root, searches)
            searches = [s for s in searches if not s.narrow(bins[s.node.first])]
        level = [child for n in level if n.shards > 1 for child in n.split()]
    return root


def points_of(docs: DataFrame, shards: int, key: str, text: str, categories: tuple[str, str]) -> DataFrame:
    """A row per document, written: doc_id, size, text_crc32, code, row, piece, pieces and the dimensions."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = written(
        docs.select(
            F.col(key).alias("doc_id"), (F.octet_length(body).cast("long") + 16).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"), text_code(body).alias("code"),
            *(_category(F.col(c)).alias(f"c{k + 1}") for k, c in enumerate(categories)),
        ).withColumn("row", text_code(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("code").cast("string"))))
    )
    groups = written(
        narrow.groupBy("code").agg(F.sum("size").alias("bytes"), F.max("size").alias("size"), F.min("c1").alias("c1"), F.min("c2").alias("c2"))
    )
    total = groups.agg(F.sum("bytes")).first()[0] or 1
    pieces = F.expr(f"(bytes * {shards * PIECES}L + {total - 1}L) div {total}L").cast("long")
    # equal texts have equal sizes, so the magnitude is the group's too
    shared = groups.select("code", pieces.alias("pieces"), _magnitude().alias("c0"), "c1", "c2")
    return written(narrow.drop("c1", "c2").join(shared, "code").withColumn("piece", F.pmod("row", "pieces")))


def assign(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", categories: tuple[str, str] = ("lang", "source")
) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 16), text_crc32, shard and slot (from 0, without gaps) of every row.

    Shards hold near equal bytes; rows of equal text share a shard but for groups of more than
    ``1 / PIECES`` of one. A null text has no bytes and counts as empty; null languages and sources
    are a value of their own, null keys are fine. Repeated rows are rows, with a slot each. An
    empty table gives an empty table; with fewer texts than shards some shards stay empty. Further
    columns of whatever name are not read. Slots follow a hash, so a shard is shuffled by itself.
    """
    points = points_of(docs, shards, key, text, categories)
    placed = points.select("doc_id", "size", "text_crc32", "code", "row", _place(_grow(points, shards)).alias("shard"))
    parts = -(-max(1, points.count()) // (shards * NUMBERED_AT_ONCE))
    placed = placed.withColumn("part", F.expr(f"row div {-(-(1 << HASH_BITS) // parts)}L"))
    counts = written(placed.groupBy("shard", "part").agg(F.count("*").alias("n")))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("row", "code")
    return (
        placed.withColumn("at", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).alias("slot"))
    )
