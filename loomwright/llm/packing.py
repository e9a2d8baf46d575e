"""Items of varying length into windows of fixed capacity with little room left.

The number of tokens is all that matters for packing, so the plan is made on the
histogram of sizes, which has at most ``capacity`` entries however large the data:

1. a text larger than a window is cut into full windows and one remainder, other
   texts are one item;
2. large items (above a third of the capacity, at most two in a window) are
   matched greedily: the largest with the largest large item that still fits;
3. the smaller ones, largest first, go where they leave the least gap, into a
   window of their own only where no gap holds them.

The plan is a table of intervals: ranks ``lo .. hi`` of a size go to consecutive
windows from ``bin`` on.  Each item learns its rank within its size by a count per
(size, salt) and a window within it, so one size that holds a third of all items
is still spread over many tasks, and finds its window by bisection in the plan.

Empty texts have no tokens and go to window 0.  Null texts are left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored
from .tokens import Tokenizer, tokenizer_sizes


@dataclass(frozen=True)
class PackConfig:
    #: items of one size and target that are numbered in one task, on average
    items_a_salt: int = 1_000_000
    tokenizer: Tokenizer = Tokenizer()


class _Gaps:
    """Runs of windows by the room left in them."""

    def __init__(self):
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

    def put(self, room: int, lo: int, hi: int) -> None:
        if room <= 0 or lo >= hi:
            return
        if room not in self.runs:
            self.runs[room] = []
            insort(self.rooms, room)
        self.runs[room].append((lo, hi))

    def take(self, size: int, most: int) -> tuple[int, int, int] | None:
        """(room, lo, hi) of up to ``most`` windows with the least room that holds ``size``."""
        k = bisect_left(self.rooms, size)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        lo, hi = self.runs[room].pop()
        if hi - lo > most:
            self.runs[room].append((lo + most, hi))
            hi = lo + most
        elif not self.runs[room]:
            del self.runs[room], self.rooms[k]
        return room, lo, hi


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(size, first rank, last rank + 1, first window): one window more for each rank more."""
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    done = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int]] = []
    gaps, bins = _Gaps(), 0

    def assign(size: int, n: int, first: int) -> None:
        out.append((size, done[size], done[size] + n, first))
        done[size] += n
        left[size] -= n

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            k = bisect_left(large, min(size, capacity - size) + 1) - 1
            while k >= 0 and not left[large[k]]:
                k -= 1
            partner = large[k] if k >= 0 else None
            if partner is None or partner == size and left[size] == 1:
                lone = 1 if partner == size else left[size]
                smaller = k - 1
                while partner == size and smaller >= 0 and not left[large[smaller]]:
                    smaller -= 1
                if partner == size and smaller >= 0:
                    assign(size, 1, bins), assign(large[smaller], 1, bins)
                    gaps.put(capacity - size - large[smaller], bins, bins + 1)
                else:
                    assign(size, lone, bins)
                    gaps.put(capacity - size, bins, bins + lone)
                bins += lone
                continue
            pairs = left[size] // 2 if partner == size else min(left[size], left[partner])
            assign(size, pairs, bins), assign(partner, pairs, bins)
            gaps.put(capacity - size - partner, bins, bins + pairs)
            bins += pairs
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            found = gaps.take(size, left[size])
            if found:
                room, lo, hi = found
                assign(size, hi - lo, lo)
                gaps.put(room - size, lo, hi)
                continue
            per, n = capacity // size, left[size]
            full = n // per
            for _ in range(per if full else 0):
                assign(size, full, bins)
            gaps.put(capacity - per * size, bins, bins + full)
            bins += full
            rest = n - full * per
            for _ in range(rest):
                assign(size, 1, bins)
            if rest:
                gaps.put(capacity - rest * size, bins, bins + 1)
                bins += 1
    return out


def pack(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_col: str = "target_name", capacity_col: str = "capacity_tokens", cfg: PackConfig = PackConfig()) -> DataFrame:
    """target_name, bin, id, part, start, tokens: every part of every text in exactly one window per target."""
    spark = docs.sparkSession
    goals = {r[0]: int(r[1]) for r in targets.where(F.col(capacity_col) > 0).select(name_col, capacity_col).distinct().collect()}
    id_kind = docs.schema[id_col].dataType.simpleString()
    if not goals:
        return spark.createDataFrame([], f"bin long, target_name string, id {id_kind}, part int, start long, tokens long")
    sizes = stored(tokenizer_sizes(docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", cfg.tokenizer), "pack-sizes")
    bulk = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    # the hottest size is that of full windows, of which there may be as many as the tokens fill
    salts = max(8, -(-(bulk["n"] + bulk["tokens"] // min(goals.values())) // cfg.items_a_salt))
    windows = F.array(*[F.struct(F.lit(n).alias("target_name"), F.lit(c).cast("long").alias("capacity")) for n, c in goals.items()])
    items = sizes.select("id", "tokens", F.explode(windows).alias("w")).select("id", "tokens", "w.*")
    last = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity"))) - 1
    items = items.select("target_name", "capacity", "id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part"))
    items = items.select(
        "target_name", "id", F.col("part").cast("int").alias("part"), (F.col("part") * F.col("capacity")).alias("start"),
        F.least("capacity", F.col("tokens") - F.col("part") * F.col("capacity")).alias("size"),
        F.pmod(F.xxhash64("id", "part"), F.lit(salts)).cast("int").alias("salt"),
    )
    counts = stored(items.groupBy("target_name", "size", "salt").agg(F.count("*").alias("n")), "pack-counts")
    plans = {}
    for name, size, n in counts.groupBy("target_name", "size").agg(F.sum("n")).collect():  # at most the sum of the capacities
        plans.setdefault(name, {})[size] = n
    order = sorted(goals)
    groups = sorted((t, size) for t, name in enumerate(order) for size in plans.get(name, {}) if size > 0)
    if len(groups) >= 1 << 23:
        raise ValueError("too many different sizes for the keys of the plan")
    number_of = {g: k for k, g in enumerate(groups)}
    keys, places = [], []
    for t, name in enumerate(order):
        for size, lo, _, first in plan(plans.get(name, {}), goals[name]):
            keys.append((number_of[t, size] << 40) | lo)
            places.append((lo, first))
    by = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    groups = np.array([(t << 48) | size for t, size in groups], dtype=np.int64)
    table = spark.sparkContext.broadcast((groups, np.array(keys, dtype=np.int64)[by], np.array(places, dtype=np.int64).reshape(-1, 2)[by]))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("target_name", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("target_name", "size", "salt", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("target_name", "size", "salt").orderBy("id", "part")) - 1
    ranked = items.withColumn("rank", rank).join(offsets, ["target_name", "size", "salt"])
    number = F.create_map(*[x for t, n in enumerate(order) for x in (F.lit(n), F.lit(t).cast("long"))]) if order else F.create_map()
    ranked = ranked.select("target_name", "id", "part", "start", F.col("size").alias("tokens"), (F.col("rank") + F.col("before")).alias("rank"), number[F.col("target_name")].alias("t"))

    def place(batches):
        groups, keys, where = table.value
        for batch in batches:
            t, size, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t", "tokens", "rank"))
            if len(keys):
                group = np.searchsorted(groups, (t << 48) | size)
                k = np.searchsorted(keys, (group << 40) | rank, side="right") - 1
                bins = np.where(size > 0, where[np.maximum(k, 0), 1] + rank - where[np.maximum(k, 0), 0], 0)
            else:
                bins = np.zeros(len(t), dtype=np.int64)
            out = {c: batch.column(c) for c in ("target_name", "id", "part", "start", "tokens")}
            yield pa.RecordBatch.from_arrays([pa.array(bins), *out.values()], names=["bin", *out])

    return ranked.mapInArrow(place, f"bin long, target_name string, id {id_kind}, part int, start long, tokens long")


def fill_report(assignment: DataFrame, targets: DataFrame) -> DataFrame:
    """target_name, capacity_tokens, windows, tokens, fill, fewest (windows that no packing can do without)."""
    used = assignment.groupBy("target_name").agg((F.max("bin") + 1).alias("windows"), F.sum("tokens").alias("tokens"))
    rows = targets.select("target_name", "capacity_tokens").distinct().join(used, "target_name")
    return rows.select("*", F.round(F.col("tokens") / (F.col("windows") * F.col("capacity_tokens")), 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("fewest"))
