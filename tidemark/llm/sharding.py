"""Sharding by minimax contiguous partition.

Documents with equal texts form an atomic group; groups stand in the order of a 64-bit hash of their text.
The smallest shard capacity for which a greedy walk over the ordered group sizes needs at most `shards`
shards is found by binary search. If that capacity is the size of a group, nothing fits beside the group in any
such partition: it gets a shard of its own, and the same is asked of the other groups and shards, until no
group forces the capacity; the order is cut there. So a group of a third of all bytes does not leave
most shards empty, and without such a group it is the plain minimax partition.

The ordered groups never reach the driver as a whole. It holds ranges of the hash order ("atoms") with their
sum, largest group and count. From a lower and an upper bound of the capacity follows an interval for every
cut; only the atoms that such an interval touches, and those whose largest group forces the bound, are split further
(one aggregation a level), until no cut can fall inside an atom. At most ATOMS rows are collected a level, at every
size of the input, and the capacity found is the exact minimum over all groups.

Defined results: a null text counts no bytes and is a group of its own; texts whose 64-bit hashes collide
count as one group; an empty table gives no rows; repeated rows are kept and numbered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import gapless_rank, materialize, utf8_bytes

#: Ranges of the hash order that the driver asks for at a level, at most.
ATOMS = 1 << 16
FIRST_BITS = 14


class Atoms:
    """Ranges of the ordered groups: first key, width in bits, sum of sizes, largest group, number of groups."""

    def __init__(self, rows):
        rows = sorted(rows)
        self.first = [r[0] for r in rows]
        self.bits = np.array([r[1] for r in rows], dtype=np.int64)
        self.sum = np.array([r[2] for r in rows], dtype=np.int64)
        self.largest = np.array([r[3] for r in rows], dtype=np.int64)
        self.count = np.array([r[4] for r in rows], dtype=np.int64)
        self.ends = np.cumsum(self.sum)
        self.starts = self.ends - self.sum
        self.total = int(self.ends[-1]) if rows else 0

    def rows(self):
        return list(zip(self.first, self.bits.tolist(), self.sum.tolist(), self.largest.tolist(), self.count.tolist()))


def greedy(ends: np.ndarray, capacity: int, shards: int, alone: np.ndarray) -> list[int] | None:
    """Indices of the first item of shards 2, 3, ...; None if more than `shards` are needed or an item is too large. alone: indices of items with a shard of their own."""
    cuts, at, done = [], 0, 0
    while at < len(ends):
        if len(cuts) == shards:
            return None
        i = int(np.searchsorted(alone, at))
        wall = int(alone[i]) if i < len(alone) else len(ends)
        nxt = at + 1 if wall == at else min(wall, int(np.searchsorted(ends, done + capacity, side="right")))
        if nxt == at:
            return None
        at, done = nxt, int(ends[nxt - 1])
        cuts.append(at)
    return cuts[:-1]


def smallest_capacity(sizes: np.ndarray, shards: int, alone: np.ndarray = np.zeros(0, np.int64)) -> int:
    """Binary search of the smallest capacity of the other shards that greedy() can keep."""
    ends, rest = np.cumsum(sizes), np.delete(sizes, alone)
    if not len(rest):
        return 0
    low = max(-(-int(rest.sum()) // max(1, shards - len(alone))), int(rest.max()))
    high = int(ends[-1])
    while low < high:
        mid = (low + high) // 2
        if greedy(ends, mid, shards, alone) is None:
            low = mid + 1
        else:
            high = mid
    return low


def bounds(atoms: Atoms, shards: int, alone: np.ndarray) -> tuple[int, int]:
    """Lower and upper bound of the capacity of the shards beside those of alone."""
    rest = np.delete(np.arange(len(atoms.sum)), alone)
    if not len(rest):
        return 0, 0
    low = max(-(-int(atoms.sum[rest].sum()) // max(1, shards - len(alone))), int(atoms.largest[rest].max()))
    return low, smallest_capacity(atoms.sum, shards, alone)


def touched(atoms: Atoms, shards: int, alone: np.ndarray, low: int, high: int) -> np.ndarray:
    """Atoms of several groups inside which a cut may fall for some capacity from low to high."""
    hit = np.zeros(len(atoms.sum), dtype=bool)
    walls = [-1, *alone.tolist(), len(atoms.sum)]
    for a, b in zip(walls, walls[1:]):
        if b - a < 2:
            continue
        begin, end = int(atoms.starts[a + 1]), int(atoms.ends[b - 1])
        left = right = begin
        for _ in range(shards):
            if left >= end:
                break
            reach = left + low
            if reach < end:
                j = int(np.searchsorted(atoms.ends, reach, side="right"))
                left = max(int(atoms.starts[j]), reach - int(atoms.largest[j]))
            else:
                left = end
            right = min(right + high, end)
            hit[a + 1 : b] |= (atoms.starts[a + 1 : b] < right) & (atoms.ends[a + 1 : b] > left)
    return np.flatnonzero(hit & (atoms.count > 1))


def forced(atoms: Atoms, alone: np.ndarray, capacity: int) -> np.ndarray:
    """Atoms beside those of alone whose largest group is as large as the capacity."""
    out = atoms.largest >= capacity
    out[alone] = False
    return np.flatnonzero(out)


def partition(atoms: Atoms, shards: int, split) -> tuple[Atoms, list[int], int]:
    """The final atoms, the indices at which shards begin, and the smallest capacity. split: atoms and indices of some of them to finer atoms."""
    own: set[int] = set()  # first keys of the groups that have a shard of their own
    largest = 0
    while True:
        alone = np.array([i for i, k in enumerate(atoms.first) if k in own], np.int64)
        low, high = bounds(atoms, shards, alone)
        pins = forced(atoms, alone, low)
        if low == high and len(pins) or not len(touched(atoms, shards, alone, low, high)):
            pins = forced(atoms, alone, high)
            if not len(pins):
                return atoms, greedy(atoms.ends, high, shards, alone), max(high, largest)
            if len(mixed := pins[atoms.count[pins] > 1]):
                atoms = split(atoms, mixed)
                continue
            more = np.union1d(alone, pins).astype(np.int64)
            if len(more) >= shards or greedy(atoms.ends, high, shards, more) is None:  # groups of no size may lie beside it
                return atoms, greedy(atoms.ends, high, shards, alone), max(high, largest)
            own.update(atoms.first[i] for i in pins)
            largest = max(largest, high)
        else:
            atoms = split(atoms, np.union1d(touched(atoms, shards, alone, low, high), pins[atoms.count[pins] > 1]))


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """groups: key (long, unique) and size. The first keys of shards 1, 2, ..., and the smallest capacity."""

    def measured(df: DataFrame, bits: int):
        rows = df.groupBy(F.shiftright("key", bits).alias("block")).agg(F.sum("size").alias("s"), F.max("size").alias("m"), F.count(F.lit(1)).alias("n")).collect()
        return [(r["block"] << bits, bits, r["s"], r["m"], r["n"]) for r in rows]

    def split(atoms: Atoms, which: np.ndarray) -> Atoms:
        rows, chosen = atoms.rows(), set(which.tolist())
        finer = max(1, int(np.log2(ATOMS / len(chosen))))
        out = [r for i, r in enumerate(rows) if i not in chosen]
        for bits in sorted({rows[i][1] for i in chosen}):
            blocks = [(rows[i][0] >> bits,) for i in chosen if rows[i][1] == bits]
            those = F.broadcast(groups.sparkSession.createDataFrame(blocks, "block long"))
            out += measured(groups.join(those, F.shiftright("key", bits) == those["block"], "left_semi"), max(0, bits - finer))
        return Atoms(out)

    atoms = Atoms(measured(groups, 64 - FIRST_BITS))
    if not atoms.total:
        return [], 0
    atoms, cuts, capacity = partition(atoms, shards, split)
    return [atoms.first[i] for i in cuts], capacity


def shard(docs: DataFrame, shards: int, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot for every row of docs."""
    text = F.col(text_col)
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("key"),
            (utf8_bytes(text) + overhead).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "shard-groups")
    keys, _ = cut_keys(groups, shards)
    number = sum((F.when(F.col("key") >= k, 1).otherwise(0) for k in keys), F.lit(0))
    n_rows = groups.agg(F.sum("n")).first()[0] or 0
    dealt = rows.withColumn("shard", number.cast("int"))
    ranked = gapless_rank(dealt, ["shard"], ["id", "key", "size", "text_crc32"], n_rows, "slot")
    return ranked.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
