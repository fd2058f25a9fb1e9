"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order hashed from their ids, form blocks. A source of weight w (its part of the sum of all
weights, as an exact fraction) has its i-th block released at slot floor((i - 1) / w) and due at slot ceil(i / w); at every
slot the released block with the earliest deadline goes next. With weights that add up to one no deadline is missed, so at
every slot each source is less than one block away from its share. Nothing repeats and no weight is rounded, so this holds
over any number of slots, for any number of sources; with `period` the weights are first rounded to whole slots of a period,
at least one for each source.

The blocks are dealt by one task that knows the number of blocks and the weight of each source, not the documents; it
keeps a heap entry per source, and writes a row per block. Documents find the slot of their block by a join.

At the first slot whose source has no block left, which stays empty, the targets end (`on_target`). The blocks left follow
by earliest deadline, so every document has a slot. Ranks inside a source are counted in slices of the hash range, so a
source with a third of all rows is never ordered by one task.

Defined cases: a null source is the source ''; rows with one id are rows of their own; a null id has the hash of null; a
source without a positive weight is an error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.storage import file_scan, located, saved

BLOCK = 32
SLICES = 4096
BATCH = 50_000  # blocks in one batch of the task that deals them


def shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Slots of each source in a period: largest remainders, at least one each."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("every source needs a positive weight")
    if len(weights) > period:
        raise ValueError("a period needs a slot for every source")
    total = sum(weights.values())
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    slots = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(slots.values())]:
        slots[s] += 1
    return slots


def deal(weights: Mapping[str, float], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, bool]]:
    """Source, number (from 0), slot and on_target of every block, by earliest deadline first."""
    if any(not 0 < w < math.inf for w in weights.values()):
        raise ValueError("every source needs a positive weight")
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * scale) for s, w in exact.items()}
    total = sum(parts.values())
    waiting = [(0, -(-total // a), s, 0) for s, a in parts.items()]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        due, source, i = heapq.heappop(ready)
        if due <= slot:
            raise ValueError("a deadline was missed")
        if i == blocks[source]:
            break
        yield source, i, slot, True
        slot, i, a = slot + 1, i + 1, parts[source]
        heapq.heappush(waiting, (i * total // a, -(-(i + 1) * total // a), source, i))
    rest = [x for x in [*ready, *(w[1:] for w in waiting)] if x[2] < blocks[x[1]]]
    heapq.heapify(rest)
    while rest:
        _, source, i = rest[0]
        slot, following = slot + 1, i + 1
        yield source, i, slot, False
        if following < blocks[source]:
            heapq.heapreplace(rest, (-(-(following + 1) * total // parts[source]), source, following))
        else:
            heapq.heappop(rest)


def schedule(slots: Mapping[str, int]) -> list[tuple[str, int]]:
    """One period of whole slots: the source and the number (from 0) of its block at each slot."""
    return [(source, i) for source, i, _, _ in deal(slots, slots)]


def dealt(sizes: DataFrame, weights: Mapping[str, float] | None, flatten: float, period: int | None, block: int) -> DataFrame:
    """source, block, slot, on_target of every block, from a table of source and n (documents)."""

    def run(batches):
        n = {r["source"]: r["n"] for b in batches for r in b.to_pylist()}
        target = {s: weights.get(s, 0.0) if weights is not None else k**flatten for s, k in sorted(n.items())}
        if target and period:
            target = shares(target, period)
        rows = []
        for row in deal(target, {s: -(-k // block) for s, k in n.items()}) if target else ():
            rows.append(row)
            if len(rows) == BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    def batch(rows):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["source", "block", "slot", "on_target"])

    return sizes.repartition(1).mapInArrow(run, "source string, block bigint, slot bigint, on_target boolean")


def slotted(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    flatten: float = 0.5,
    period: int | None = None,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """Per row: id, source, block, slot, place (in its block), on_target, and the row's place in its file.

    `weights` are the target shares (any scale). Without them the share of a source is its number of documents to the power
    `flatten`. `period` rounds the shares to whole slots of a period, which
    has to be as long as there are sources. The order of the mix is (slot, place).
    """
    docs = file_scan(docs)
    source = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    rows = located(docs, ident.alias("id"), source.alias("source"), F.xxhash64(F.lit(seed), ident.cast("string")).alias("hash"))
    rows = saved(rows.withColumn("slice", F.pmod(F.col("hash"), F.lit(SLICES)).cast("int")), "mix-keys")
    counts = saved(rows.groupBy("source", "slice").agg(F.count(F.lit(1)).alias("n")), "mix-slices")
    sizes = saved(counts.groupBy("source").agg(F.sum("n").alias("n")), "mix-sizes")  # one row per source
    layout = saved(dealt(sizes, weights, flatten, period, block), "mix-slots")

    before = F.sum("n").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("source", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "slice").orderBy("hash", "id", "_path", "_row"))
    ranked = rows.withColumn("inside", inside).join(starts, ["source", "slice"])
    rank = F.col("before") + F.col("inside") - 1
    ranked = ranked.withColumn("block", F.floor(rank / block)).withColumn("place", (rank % block).cast("int"))
    mixed = ranked.join(layout, ["source", "block"])
    return mixed.select("id", "source", "block", "slot", "place", "on_target", "_path", "_row")


def mix(docs: DataFrame, partitions: int | None = None, **options) -> DataFrame:
    """The rows of `docs` in the order of the mix: ranges of slots over partitions, ordered inside each."""
    docs = file_scan(docs)
    order = slotted(docs, **options).select("_path", "_row", "slot", "place")
    rows = located(docs, F.struct("*").alias("doc")).join(order, ["_path", "_row"])
    ranges = (partitions,) if partitions else ()
    return rows.repartitionByRange(*ranges, "slot", "place").sortWithinPartitions("slot", "place").select("doc.*")
