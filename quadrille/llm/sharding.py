"""Sharding by a minimax contiguous partition.

Rows with equal texts form an atomic group.  Groups are laid in a fixed order and cut into contiguous shards so that
the largest shard is as small as any contiguous cut allows: the capacity is found by binary search, each candidate
checked greedily, and the cuts are those of the smallest feasible one.

The search needs only places where a cut may fall.  It starts from a bounded number of prefix sums (one for each block
of equal share), finds the range of capacities that these leave open, and fetches finer prefix sums only inside the
stretches where some capacity of that range would cut; it ends when nothing is open.  The driver thus holds a bounded
number of prefix sums whatever the number of groups.

Defined results: a null text has no bytes and is equal to other null texts, not to an empty one.  Repeated rows belong
to one group and get slots of their own.  With fewer groups than shards the last shards stay empty; an empty table
gives an empty result.  A group larger than the ideal shard stays whole and sets the capacity.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, prefix_sums

#: Prefix sums fetched for the whole line at first, and for all open stretches in each later round.
POINTS = 4096


def _greedy(ends: list[int], is_open: set[int], total: int, capacity: int, shards: int, hopeful: bool) -> list[int] | None:
    """Cuts of the greedy fill, or none if it needs more shards.

    ``hopeful`` lets a cut fall anywhere inside an open stretch, which no real cut can beat.
    """
    cuts, at = [], 0
    for _ in range(shards):
        reach = at + capacity
        if reach >= total:
            return cuts
        i = bisect_right(ends, reach) - 1
        at_next = reach if hopeful and ends[i] in is_open else ends[i]
        if at_next <= at:
            return None
        at = at_next
        cuts.append(at)
    return None


def minimax_cuts(fetch, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and its cuts, for a line of ``total`` cut into at most ``shards`` parts.

    ``fetch(stretches)`` takes ``[(start, end)]`` and returns for each its blocks: the first and the last end of a
    group in the block, and the number of ends.  The first call is for the whole line.
    """
    if not total:
        return 0, []
    ends, is_open = {0, total}, {0}
    low, high = max(largest, -(-total // shards)) - 1, total  # low fails or is untried, high works
    wanted = [(0, total)]
    while wanted:
        is_open -= {start for start, _ in wanted}
        for blocks in fetch(wanted):
            for least_end, last_end, n in blocks:
                ends |= {least_end, last_end}
                if n > 2:
                    is_open.add(least_end)
        line = sorted(ends)

        def smallest(hopeful: bool, lo: int, hi: int, line=line) -> int:
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if _greedy(line, is_open, total, mid, shards, hopeful) is None:
                    lo = mid
                else:
                    hi = mid
            return hi

        high = smallest(False, low, high)
        low = smallest(True, low, high) - 1
        first = _greedy(line, is_open, total, low + 1, shards, True) or []
        last = _greedy(line, is_open, total, high, shards, True) or []
        last += [total] * (len(first) - len(last))
        starts = set()
        for a, b in zip(first, last, strict=False):  # a capacity in between cuts in between
            i = bisect_right(line, min(a, b)) - 1
            while i < len(line) - 1 and line[i] <= max(a, b):
                if line[i] in is_open:
                    starts.add(i)
                i += 1
        wanted = [(line[i], line[i + 1]) for i in sorted(starts)]
    return high, _greedy(sorted(ends), set(), total, high, shards, False) or []


def shard(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Return ``id_col, size, text_crc32, shard, slot, group_first`` for every row.

    ``size`` is the text's bytes and one; ``slot`` numbers a shard's rows from 0 without gaps, in the order of groups
    (by the smallest id in them), then ids.
    """
    bytes_ = F.coalesce(F.octet_length(text), F.lit(0))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (bytes_ + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(text, F.col(text).isNull()).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
    )
    rows = materialise(rows, "rows")
    groups = rows.groupBy("t1", "t2").agg(F.min("id").alias("first"), F.sum("size").alias("bytes"), F.count("*").alias("n"))
    placed = materialise(prefix_sums(groups, [F.col("first"), F.col("t1"), F.col("t2")], "bytes", "before"), "groups")
    line = placed.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest")).first()
    total, largest = line["total"] or 0, line["largest"] or 0
    ends = placed.select((F.col("before") + F.col("bytes")).alias("end"))

    def fetch(stretches: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
        per = max(2, POINTS // len(stretches))
        which = F.lit(None).cast("int")
        for i, (a, b) in enumerate(stretches):
            which = F.when((F.col("end") > a) & (F.col("end") <= b), F.lit(i)).otherwise(which)
        starts, widths = F.lit([a for a, _ in stretches]), F.lit([max(1, -(-(b - a) // per)) for a, b in stretches])
        block = F.floor((F.col("end") - F.element_at(starts, F.col("i") + 1) - 1) / F.element_at(widths, F.col("i") + 1))
        blocks = ends.select("end", which.alias("i")).where("i is not null").groupBy("i", block.alias("block"))
        out: list[list[tuple[int, int, int]]] = [[] for _ in stretches]
        for r in blocks.agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count_distinct("end").alias("n")).collect():
            out[r["i"]].append((r["a"], r["b"], r["n"]))
        return out

    _, cuts = minimax_cuts(fetch, total, largest, shards)
    number = F.lit(0)
    for c in cuts:
        number = number + (F.col("before") >= c).cast("int")
    named = materialise(placed.select("t1", "t2", "first", "n", number.alias("shard")), "named")
    rows = heavy_join(rows, named, ["t1", "t2"], "n").drop("n")
    order = [F.col("shard"), F.col("first"), F.col("t1"), F.col("t2"), F.col("id")]
    counted = materialise(prefix_sums(rows.withColumn("one", F.lit(1).cast("long")), order, "one", "at"), "slots")
    starts = {r["shard"]: r["at"] for r in counted.groupBy("shard").agg(F.min("at").alias("at")).collect()}
    base = F.element_at(F.lit([starts.get(i, 0) for i in range(shards)]), F.col("shard") + 1)
    return counted.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").cast("long").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("at") - base).cast("long").alias("slot"),
        F.col("first").alias("group_first"),
    )
