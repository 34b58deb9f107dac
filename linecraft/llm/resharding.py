"""Resharding by minimum-cost flow.

Rows lie in old shards and are to lie in new ones of nearly equal bytes, with
as few bytes moved as can be. A row's size is the UTF-8 bytes of its text (null:
none) plus 16.

The driver sees the total of each old shard and the blocks: the documents
larger than a ``FINE``-th of an equal share, fewer than ``shards * FINE`` of them
whatever the input. A minimum-cost flow from old shards to new capacities says
how many bytes go from shard to shard (successive cheapest paths; a byte that
stays costs nothing, by default any other costs 1). Blocks fill these flows, the
largest first; a second flow sends the bytes of all smaller rows to the room that
is left. These rows lie end to end on a tape per old shard, which the flows cut
into intervals; a row goes where its middle byte lies. So shards differ by a
few of the smaller rows. A document larger than an equal share has a shard to
itself, and the others share the rest.

``reshard`` returns the place of each row; ``rewrite`` writes the affected
shards of a dataset partitioned by ``shard`` and leaves the files of the others.
Equal texts, repeated rows and rows that share a doc_id are rows like others.
Null texts have no bytes and the crc32 0. Ties in size go by old shard and place
in the input. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import release, stored, tidy

SHARDS, ROW_BYTES = 40, 16
#: Documents of more than this part of an equal share are blocks of their own.
FINE = 1024
#: Rows of a file that are laid on a tape together.
TAPE_ROWS = 1 << 16


# --- flows -------------------------------------------------------------------


def cheapest_flow(supply, capacity, cost) -> np.ndarray:
    """Amounts from each supply to each capacity at the least total cost.

    Successive cheapest paths in the residual graph of the transport problem;
    all amounts are whole. The capacities hold the supplies.
    """
    left, room = [np.array(x, dtype=object) for x in (supply, capacity)]
    cost = np.asarray(cost, float)
    n, m = cost.shape
    flow = np.zeros((n, m), dtype=object)
    if sum(room) < sum(left):
        raise ValueError("capacities are smaller than supplies")
    while True:
        sources = np.array([x > 0 for x in left], bool)
        if not sources.any():
            return flow
        used = flow > 0
        near = np.where(sources, 0.0, np.inf)  # cheapest way to each old shard
        far = np.full(m, np.inf)  # and to each new one
        back, come = np.full(n, -1), np.full(m, -1)
        while True:
            ways = near[:, None] + cost
            via = ways.argmin(axis=0)
            # only what is strictly cheaper, so that ways never run in a circle
            better = ways[via, np.arange(m)] < far - 1e-9
            far[better] = ways[via[better], better]
            come[better] = via[better]
            undo = np.where(used, far[None, :] - cost, np.inf)
            via = undo.argmin(axis=1)
            better = undo[np.arange(n), via] < near - 1e-9
            if not better.any():
                break
            near[better] = undo[better, via[better]]
            back[better] = via[better]
        free = np.array([x > 0 for x in room], bool)
        to = int(np.where(free, far, np.inf).argmin())
        path, amount, j = [], room[to], to
        while True:
            i = int(come[j])
            path.append((i, j, 1))
            if sources[i] and back[i] < 0:
                amount = min(amount, left[i])
                break
            path.append((i, int(back[i]), -1))
            amount = min(amount, flow[i, back[i]])
            j = int(back[i])
        for a, b, sign in path:
            flow[a, b] += sign * amount
        left[path[-1][0]] -= amount
        room[to] -= amount


def moving_costs(old: int, new: int) -> np.ndarray:
    """A byte that stays costs nothing, any other 1."""
    return 1.0 - np.eye(old, new)


def _filled(total: int, taken: list[int]) -> list[int]:
    """Room of each shard when all are filled to one level above what they hold."""
    order = sorted(range(len(taken)), key=lambda j: taken[j])
    for k in range(len(order), 0, -1):
        low = order[:k]
        level, more = divmod(total + sum(taken[j] for j in low), k)
        if level >= taken[low[-1]]:
            room = [0] * len(taken)
            for at, j in enumerate(low):
                room[j] = level + (at < more) - taken[j]
            return room
    return [0] * len(taken)


class Plan:
    """Shard of each block, and for each old shard the ends of its tape's
    intervals with their shards."""

    def __init__(self, totals: list[int], blocks: list[tuple[int, int]], shards: int, cost=None):
        """``blocks``: (old shard, bytes) of each block, counted in ``totals``."""
        old = len(totals)
        cost = moving_costs(old, shards) if cost is None else np.asarray(cost, float)
        order = sorted(range(len(blocks)), key=lambda b: (-blocks[b][1], blocks[b][0], b))
        self.shard_of = [-1] * len(blocks)
        supply, free = list(totals), set(range(shards))
        # documents above an equal share of what is left
        rest, alone = sum(totals), 0
        for b in order:
            home, size = blocks[b]
            if len(free) < 2 or size * len(free) <= rest:
                break
            near = min(free, key=lambda j: (cost[home, j], totals[j] if j < old else 0, j))
            free.remove(near)
            self.shard_of[b], alone = near, alone + 1
            supply[home] -= size
            rest -= size
        open_to = sorted(free)
        own_cost = cost[:, open_to]
        first = cheapest_flow(supply, _filled(rest, [0] * len(open_to)), own_cost)
        held = [0] * len(open_to)
        for b in order[alone:]:
            home, size = blocks[b]
            j = max(range(len(open_to)), key=lambda j: (first[home, j], -own_cost[home, j], -j))
            first[home, j] -= size
            held[j] += size
            supply[home] -= size
            self.shard_of[b] = open_to[j]
        second = cheapest_flow(supply, _filled(sum(supply), held), own_cost)
        self.intervals: list[list[tuple[int, int]]] = []
        for i in range(old):
            at, ends = 0, []
            for j, shard in enumerate(open_to):
                if second[i, j]:
                    at += int(second[i, j])
                    ends.append((at, shard))
            self.intervals.append(ends or [(0, open_to[0])])


# --- rows --------------------------------------------------------------------


def _before(rows: DataFrame, by: str, amount) -> DataFrame:
    """``rows`` (with ``file, block, at``) and ``before``: the sum of ``amount``
    over the rows of the same ``by`` that come earlier. Groups that meet in a
    task have at most ``TAPE_ROWS`` rows."""
    group = [by, "file", "block"]
    sums = rows.groupBy(*group).agg(F.sum(amount).alias("own"))
    order = Window.partitionBy(by).orderBy("file", "block")
    sums = sums.select(*group, (F.sum("own").over(order) - F.col("own")).alias("base"))
    inside = F.sum(amount).over(Window.partitionBy(*group).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    own = rows.withColumn("inside", inside - amount)
    return own.join(sums, group).withColumn("before", F.col("base") + F.col("inside")).drop("base", "inside")


def _placer(plan, names, limit):
    """Adds the shard of each row."""
    blocks, ends, shards = plan

    def place(batches):
        for b in batches:
            size, old, before = (np.asarray(b[c]) for c in ("size", "old", "before"))
            out = np.zeros(b.num_rows, np.int32)
            for i in np.unique(old):
                own = np.flatnonzero(old == i)
                at = np.searchsorted(ends[i], before[own] + size[own] // 2, side="right")
                out[own] = np.asarray(shards[i])[np.minimum(at, len(ends[i]) - 1)]
            for k in np.flatnonzero(size > limit):
                out[k] = blocks[b["file"][int(k)].as_py(), b["at"][int(k)].as_py()]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in names), pa.array(out)], [*names, "shard"])

    return place


def _placed(narrow: DataFrame, olds: int, shards: int, cost=None, fine: int = FINE) -> DataFrame:
    """A stored table with ``size`` and ``old`` (0 to olds - 1), and ``shard``."""
    at = F.col("_metadata.row_index")
    rows = narrow.select(
        *narrow.columns, F.col("_metadata.file_name").alias("file"), F.floor(at / TAPE_ROWS).alias("block"), at.alias("at")
    )
    totals = [0] * olds
    for r in narrow.groupBy("old").agg(F.sum("size").alias("size")).collect():
        totals[r["old"]] = r["size"]
    limit = sum(totals) // (shards * fine)
    large = rows.where(F.col("size") > limit).select("old", "size", "file", "at").collect()
    large.sort(key=lambda r: (r["old"], r["file"], r["at"]))
    plan = Plan(totals, [(r["old"], r["size"]) for r in large], shards, cost)
    blocks = {(r["file"], r["at"]): plan.shard_of[k] for k, r in enumerate(large)}
    sent = (blocks, [np.array([e for e, _ in x]) for x in plan.intervals], [[j for _, j in x] for x in plan.intervals])
    small = F.when(F.col("size") > limit, F.lit(0)).otherwise(F.col("size"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema)
    return _before(rows, "old", small).mapInArrow(tidy(_placer(sent, narrow.columns, limit)), f"{kinds}, shard int")


def _sized(docs: DataFrame, *cols) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES
    return docs.select(*cols, size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"))


def reshard(docs: DataFrame, old, olds: int, shards: int = SHARDS, cost=None, fine: int = FINE) -> DataFrame:
    """Places of all rows (``doc_id, text`` and the old shard, a column or
    expression from 0 to ``olds`` - 1): ``doc_id, size, text_crc32, old, shard,
    slot``. ``cost``: of a byte from each old to each new shard."""
    narrow = stored(_sized(docs, F.col("doc_id").cast("bigint").alias("doc_id"), old.cast("int").alias("old")), "sizes")
    placed = stored(_placed(narrow, olds, shards, cost, fine), "placed")
    release(narrow)
    at = F.col("_metadata.row_index")
    rows = placed.select(
        *placed.columns, F.col("_metadata.file_name").alias("file"), F.floor(at / TAPE_ROWS).alias("block"), at.alias("at")
    )
    slots = _before(rows, "shard", F.lit(1).cast("bigint"))
    return slots.select("doc_id", "size", "text_crc32", "old", "shard", F.col("before").alias("slot"))


def rewrite(spark: SparkSession, source: str, target: str, shards: int, cost=None, fine: int = FINE) -> DataFrame:
    """Reshard a Parquet dataset partitioned by ``shard`` (from 0).

    Writes to ``target``, partitioned alike, the new contents of every shard that
    a row leaves or enters; the files of all other shards are still right where
    they are. Returns the transfers: ``old, shard, rows, bytes``.
    """
    docs = spark.read.parquet(source)
    olds = (docs.agg(F.max("shard")).first()[0] or 0) + 1
    where = [F.col("_metadata.file_path").alias("from_file"), F.col("_metadata.row_index").alias("from_row")]
    narrow = stored(_sized(docs, *where, F.col("shard").cast("int").alias("old")).drop("text_crc32"), "sizes")
    placed = stored(_placed(narrow, olds, shards, cost, fine), "placed")
    release(narrow)
    transfers = placed.groupBy("old", "shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    moved = [(r["old"], r["shard"]) for r in transfers.where("old <> shard").collect()]
    affected = sorted({x for pair in moved for x in pair})
    rows = docs.where(F.col("shard").isin(affected)).drop("shard").select("*", *where)
    new = placed.where(F.col("old").isin(affected)).select("from_file", "from_row", "shard")
    written = rows.join(new, ["from_file", "from_row"]).drop("from_file", "from_row")
    written.write.partitionBy("shard").parquet(target)
    return transfers


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of the query ``op12``: documents lie by source in
    as many old shards, crc32 of the source (null: empty) modulo their number."""
    old = F.pmod(F.crc32(F.coalesce(F.col("source").cast("string"), F.lit("")).cast("binary")), F.lit(SHARDS))
    return reshard(docs, old, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"),
    )
