"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are a group and stay together. Groups, largest first, enter the open shard with the least room
that still holds them, found in a balanced tree of the shards' free room.

Packing runs on two levels, so no task and not the driver sees all groups. A group of at least ``CRATE`` of a shard's
share is packed on its own; there are at most shards / CRATE of these. Smaller groups are first packed, by the same
rule and in parallel, into crates of that size. The last step packs large groups and crates: a number of items
that depends on the number of shards and tasks, not on the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

#: A crate's share of a shard's bytes.
CRATE = 1 / 500
#: Bytes that every row costs besides its text.
ROW_BYTES = 16
#: Rows that are numbered together, about.
SLOT_ROWS = 100_000


class Room:
    """Balanced tree (treap) of (free room, bin)."""

    def __init__(self) -> None:
        self.root: list | None = None
        self._seed = 88172645463325252

    def _priority(self) -> int:
        x = self._seed
        x ^= (x << 13) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 7
        x ^= (x << 17) & 0xFFFFFFFFFFFFFFFF
        self._seed = x
        return x

    def add(self, key: tuple[int, int]) -> None:
        node = [key, self._priority(), None, None]
        path, at = [], self.root
        while at is not None and at[1] >= node[1]:
            side = 3 if key > at[0] else 2
            path.append((at, side))
            at = at[side]
        low, high = _split(at, key)
        node[2], node[3] = low, high
        if path:
            path[-1][0][path[-1][1]] = node
        else:
            self.root = node

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest free room of at least size."""
        best, at = None, self.root
        while at is not None:
            if at[0][0] >= size:
                best, at = at[0], at[2]
            else:
                at = at[3]
        return best

    def remove(self, key: tuple[int, int]) -> None:
        parent, side, at = None, 0, self.root
        while at[0] != key:
            parent, side = at, 3 if key > at[0] else 2
            at = at[side]
        under = _joined(at[2], at[3])
        if parent is None:
            self.root = under
        else:
            parent[side] = under


def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
    low = high = None
    low_end = high_end = None
    while node is not None:
        if node[0] < key:
            if low_end is None:
                low = node
            else:
                low_end[3] = node
            low_end, node = node, node[3]
        else:
            if high_end is None:
                high = node
            else:
                high_end[2] = node
            high_end, node = node, node[2]
    if low_end is not None:
        low_end[3] = None
    if high_end is not None:
        high_end[2] = None
    return low, high


def _joined(low: list | None, high: list | None) -> list | None:
    head: list = [None, None, None, None]
    end, side = head, 2
    while low is not None and high is not None:
        if low[1] >= high[1]:
            end[side] = low
            end, side, low = low, 3, low[3]
        else:
            end[side] = high
            end, side, high = high, 2, high[2]
    end[side] = low if low is not None else high
    return head[2]


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; sizes must fall. An item over the capacity has a bin of its own."""
    room, bins, placed = Room(), 0, []
    for size in sizes:
        spot = room.tightest(size)
        if spot is None:
            spot = (max(capacity, size), bins)
            bins += 1
        else:
            room.remove(spot)
        room.add((spot[0] - size, spot[1]))
        placed.append(spot[1])
    return placed


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Bin of each item, sizes falling, in at most ``shards`` bins of near equal fill.

    An item that outweighs a fair share of what is left has a bin of its own. The others go by best fit into the rest
    at the least capacity for which the rest suffices.
    """
    total, own = sum(sizes), 0
    while own < min(len(sizes), shards - 1) and sizes[own] * (shards - own) > total:
        total -= sizes[own]
        own += 1
    rest, bins = sizes[own:], shards - own
    if not rest:
        return list(range(own))
    low, high = max(rest[0], -(-total // bins)), None
    tried, step = low, max(1, low // 2000)
    while high is None:
        placed = best_fit(rest, tried)
        if max(placed) < bins:
            high, best = tried, placed
        else:
            low, tried, step = tried + 1, tried + step, step * 2
    while high - low > max(1, high // 20_000):
        tried = (low + high) // 2
        placed = best_fit(rest, tried)
        if max(placed) < bins:
            high, best = tried, placed
        else:
            low = tried + 1
    return [*range(own), *(own + x for x in best)]


def shard(frame: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = 40) -> DataFrame:
    """A row per row of the frame: its id, size (UTF-8 bytes of the text and 16), text_crc32, shard and slot.

    Rows of equal text share a shard; null and empty texts are equal. The shards' bytes come as near to equal as
    whole groups allow: a group larger than a fair share has a shard to itself. Slots number the rows of a shard
    from 0 without gaps, in no order that matters; repeated rows have slots of their own. With fewer groups than shards some shards
    stay empty. An empty table gives an empty table.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = frame.select(
        F.col(f"`{id_column}`").alias("id"),
        (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("crc"),
        F.unhex(F.sha2(content, 256)).alias("group"),
    )
    rows = stored(rows, "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    crate = max(1, int(total / shards * CRATE))
    spark = frame.sparkSession

    def into_crates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, crates, number = Room(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            placed = []
            for size in batch["size"].to_pylist():
                spot = room.tightest(size)
                if spot is None:
                    spot = (crate, crates)
                    crates += 1
                else:
                    room.remove(spot)
                if spot[0] > size:
                    room.add((spot[0] - size, spot[1]))
                placed.append(spot[1])
            number = batch["part"][0].as_py()
            names = pa.array([f"{number}-{x}" for x in placed])
            yield pa.RecordBatch.from_arrays([batch["group"], batch["size"], names], ["group", "size", "item"])

    small = groups.where(F.col("size") < crate)
    small = small.repartition(F.xxhash64("group")).sortWithinPartitions(F.desc("size"), "group").withColumn("part", F.spark_partition_id())
    small = small.mapInArrow(into_crates, "group binary, size long, item string")
    large = groups.where(F.col("size") >= crate).select("group", "size", F.hex("group").alias("item"))
    items = stored(small.union(large), "shard-items")
    listed = items.groupBy("item").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "item").collect()
    bins = pack_into([r["size"] for r in listed], shards)
    placed = spark.createDataFrame(
        pa.table({"item": pa.array([r["item"] for r in listed], pa.string()), "shard": pa.array(bins, pa.int32())})
    )
    homes = stored(items.join(placed, "item").select("group", "shard"), "shard-homes")
    # numbered within (shard, bucket); the rows in the buckets before come from a small table of counts
    buckets = max(1, -(-rows.count() // SLOT_ROWS)) * 8
    homed = rows.join(homes, "group").withColumn("bucket", F.pmod(F.xxhash64("id", "crc"), F.lit(buckets)).cast("int"))
    homed = stored(homed, "shard-homed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = homed.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("shard", "bucket").orderBy("id", "group")
    numbered = homed.withColumn("at", F.row_number().over(within) - 1).join(counts, ["shard", "bucket"])
    return numbered.select(F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("at") + F.col("before")).alias("slot"))
