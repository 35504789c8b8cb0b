"""Sharding by best-fit-decreasing bin packing.

Groups of rows that must stay together (here: equal texts) are packed, largest
first, each into the fullest shard that still takes it.  The free space of the
shards is kept in a balanced search tree (a treap), so finding a shard costs
O(log shards).  ``pack`` packs into as few shards of a given capacity as it finds;
``even`` bisects the capacity until the wanted number of shards is just enough,
which leaves the shards nearly equal.

Groups of one size are interchangeable, and best fit puts them into the tightest
shard until it takes no more of them.  So what is packed is a table of sizes, each
with its number of groups, and the answer for a size is a list of shards with how
many of its groups they get.  Only these come to the driver: different sizes are few
however many groups there are (n different sizes need n * n / 2 bytes of text at least).
The groups of a size are numbered on Spark, in slices side by side, and handed out by number.

A group larger than its share of what is left gets a shard of its own, and the
other shards share the rest: one text that is a third of all bytes cannot be
split, but it doesn't starve the others.

Defined cases: a null text is empty, size 1, and equal to the empty text; groups of equal
size go by a hash of their text; repeated rows are rows of their own; an empty table
gives no rows; columns beyond the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roomtrace.llm.tables import read, text_or_empty
from roomtrace.session import work_dir

SHARDS = 16
#: Rows of a shard, and groups of a size, are numbered side by side in slices of about this many, 64 slices at least.
SLICE_ROWS = 200_000

#: A size and its number of groups; a shard and how many groups it gets.
Class = tuple[int, int]
Share = tuple[int, int]


class _Node:
    __slots__ = ("key", "rank", "left", "right")

    def __init__(self, key: tuple[int, int], rank: int) -> None:
        self.key, self.rank = key, rank
        self.left: _Node | None = None
        self.right: _Node | None = None


def _split(node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """The entries below ``key``, and the others."""
    if node is None:
        return None, None
    if node.key < key:
        node.right, high = _split(node.right, key)
        return node, high
    low, node.left = _split(node.left, key)
    return low, node


def _merge(low: _Node | None, high: _Node | None) -> _Node | None:
    if low is None or high is None:
        return low or high
    if low.rank > high.rank:
        low.right = _merge(low.right, high)
        return low
    high.left = _merge(low, high.left)
    return high


class FreeSpace:
    """Shards by free space, then number, in a treap: a search tree that is a heap by pseudo-random ranks,
    which keeps its depth logarithmic whatever the order of insertions."""

    def __init__(self) -> None:
        self.root: _Node | None = None
        self._state = 0x9E3779B9

    def add(self, entry: tuple[int, int]) -> None:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        low, high = _split(self.root, entry)
        self.root = _merge(_merge(low, _Node(entry, self._state >> 16)), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the shard with the least free space of at least ``size``."""
        low, high = _split(self.root, (size, -1))
        least, rest = _least(high)
        self.root = _merge(low, rest)
        return least


def _least(node: _Node | None) -> tuple[tuple[int, int] | None, _Node | None]:
    """The least entry, and the tree without it."""
    if node is None:
        return None, None
    if node.left is None:
        return node.key, node.right
    at = node
    while at.left.left is not None:
        at = at.left
    key, at.left = at.left.key, at.left.right
    return key, node


def pack_classes(classes: Sequence[Class], capacity: int, most: int | None = None) -> list[list[Share]] | None:
    """Best fit of all groups of ``classes``, largest size first: per class the shards that get some, in that order.

    None if a size is above the capacity or ``most`` shards don't do.
    """
    free, used, out = FreeSpace(), 0, []
    for size, count in classes:
        shares: list[Share] = []
        while count:
            entry = free.take_tightest(size)
            if entry is None:
                if size > capacity or used == most:
                    return None
                entry = (capacity, used)
                used += 1
            # The tightest shard stays the tightest while it takes more of the same size.
            n = min(count, entry[0] // size)
            shares.append((entry[1], n))
            free.add((entry[0] - n * size, entry[1]))
            count -= n
        out.append(shares)
    return out


def classes_of(sizes: Iterable[int]) -> list[Class]:
    counts: dict[int, int] = {}
    for size in sizes:
        counts[size] = counts.get(size, 0) + 1
    return sorted(counts.items(), reverse=True)


def pack(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each size; None if a size is above the capacity or ``most`` shards don't do."""
    classes = classes_of(sizes)
    found = pack_classes(classes, capacity, most)
    if found is None:
        return None
    shards = {size: iter([s for s, n in shares for _ in range(n)]) for (size, _), shares in zip(classes, found)}
    return [next(shards[size]) for size in sizes]


def even(classes: Sequence[Class], shards: int) -> list[list[Share]]:
    """Packs into ``shards`` shards of the least capacity for which best fit needs no more; ``classes`` are sorted, largest first."""
    out: list[list[Share]] = [[] for _ in classes]
    left = list(classes)
    total, first, at = sum(s * n for s, n in left), 0, 0
    while at < len(left) and first < shards - 1 and left[at][0] * (shards - first) > total:
        size, count = left[at]
        out[at].append((first, 1))
        total, first = total - size, first + 1
        left[at] = (size, count - 1)
        at += count == 1
    left = left[at:]
    low = max(-(-total // (shards - first)), left[0][0] if left else 0)
    high, found = low, pack_classes(left, low, shards - first)
    step = 1
    while found is None:
        low, high = high + 1, high + step
        found, step = pack_classes(left, high, shards - first), step * 2
    while low < high:
        middle = (low + high) // 2
        tried = pack_classes(left, middle, shards - first)
        if tried is None:
            low = middle + 1
        else:
            high, found = middle, tried
    for i, shares in enumerate(found):
        out[at + i] += [(first + s, n) for s, n in shares]
    return out


def group_key(text: Column) -> Column:
    """Equal texts have equal keys; a collision would only keep more texts together."""
    return F.xxhash64(text, F.crc32(text))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for all rows."""
    spark = docs.sparkSession
    text = text_or_empty()
    path = work_dir(spark, "shard-sizes")
    # Texts are read once; what is planned and numbered afterwards are four numbers a row.
    docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        group_key(text).alias("group"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    placed = rows.join(_placed_groups(rows, shards), "group").select("doc_id", "size", "text_crc32", "shard")
    return with_slots(placed, 64 + rows.count() // (shards * SLICE_ROWS))


def _placed_groups(rows: DataFrame, shards: int) -> DataFrame:
    """``group, shard`` of ``group, size``: each group in the shard that its number among those of its size falls to."""
    spark = rows.sparkSession
    path = work_dir(spark, "shard-groups")
    rows.groupBy("group").agg(F.sum("size").alias("bytes")).write.parquet(path)
    groups = spark.read.parquet(path)
    # A row per different size.
    classes = [(r.bytes, r.n) for r in groups.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.col("bytes").desc()).collect()]
    shares = even(classes, shards)
    ends = [(size, [s for s, _ in of], _running(n for _, n in of)) for (size, _), of in zip(classes, shares)]
    table = spark.createDataFrame(ends, "bytes bigint, shards array<int>, ends array<bigint>")
    slices = 64 + groups.count() // SLICE_ROWS
    sliced = groups.withColumn("slice", F.pmod("group", F.lit(slices)))
    within = Window.partitionBy("bytes", "slice").orderBy("group")
    before = Window.partitionBy("bytes").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("bytes", "slice").agg(F.count("*").alias("n"))
        .select("bytes", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        .join(table, "bytes")
    )
    numbered = sliced.withColumn("at", F.row_number().over(within) - 1).join(starts, ["bytes", "slice"])
    nth = F.size(F.filter("ends", lambda end: end <= F.col("start") + F.col("at")))
    return numbered.select("group", F.get("shards", nth).alias("shard"))


def _running(counts: Iterable[int]) -> list[int]:
    total, out = 0, []
    for n in counts:
        total += n
        out.append(total)
    return out


def with_slots(rows: DataFrame, slices: int = 64) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps, ``slices`` slices of a shard side by side.

    Slices follow a hash of the row, so no text or shard is numbered in one task.
    """
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slices)).cast("int"))
    # shards * slices rows.
    counts = rows.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["shard", "slice"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("bigint").alias("slot"))
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
