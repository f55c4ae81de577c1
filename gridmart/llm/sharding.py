"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` equal cells.  Every shard has ``VNODES`` virtual nodes
on cells given by a hash of its number; a row's cell is given by a hash of its
key.  A row belongs to the next virtual node clockwise.  Loads are bounded: a
shard that is full takes no more, and the rows of a cell that find it full
continue clockwise to the next virtual node of a shard with room.  With the
bounds at the floor and ceiling of rows / shards, counts are at most one apart
(law ``rows``); with ``slack`` the bound is (1 + slack) times the mean and
fewer rows move when a shard is added.

All rows of a cell meet the same shards in the same order, so the walk is done
on the cells' row counts (``CELLS`` numbers at most, whatever the table) and
gives each cell a few ranges of ranks with their shards.  A row's rank in its
cell comes from a window over the cell.  Cells are uniform because keys are
hashed, so no window is hot.  All work on rows is DataFrame operations.

Defined results: size is the text's UTF-8 bytes plus 16, a null text has none
and the CRC of no bytes; a null doc_id is placed by its text.  Rows that are
equal in all these are interchangeable.  An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CELL_BITS = 14
CELLS = 1 << CELL_BITS
VNODES = 64
ROW_OVERHEAD = 16


def ring(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise.  A virtual node whose
    cell is taken moves to the next free one; shards are placed in order, so a
    further shard moves no earlier virtual node."""
    if shards < 1 or shards * vnodes > cells:
        raise ValueError(f"1 to {cells // vnodes} shards")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            cell = int(hashlib.md5(f"{shard}/{v}".encode()).hexdigest()[:8], 16) % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, vnodes: int = VNODES, cells: int = CELLS,
         slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first rank).

    All cells step clockwise together; at each step the cells go round the
    ring in order.  A range beyond a cell's first needs a shard that became
    full, so there are at most ``cells + shards`` ranges."""
    nodes = ring(shards, vnodes, cells)
    at = [cell for cell, _ in nodes]
    room, used = bounds(sum(counts.values()), shards, slack), [0] * shards
    waiting = [(cell, bisect_left(at, cell), 0, n) for cell, n in sorted(counts.items()) if n]
    pieces, hop = [], 0
    while waiting:
        moved = []
        for cell, home, done, n in waiting:
            shard = nodes[(home + hop) % len(nodes)][1]
            take = min(n - done, room[shard])
            if take:
                pieces.append((cell, done, done + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
            if done + take < n:
                moved.append((cell, home, done + take, n))
        waiting, hop = moved, hop + 1
    return pieces


def shard(docs: DataFrame, shards: int = 40, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (position in the shard,
    gapless from 0), grown_shard (null under this law), cell."""
    rows = common.columns(docs, {"doc_id": "long", "text": "string"}).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"),
                              F.concat(F.lit("null:"), F.coalesce("text", F.lit(""))))).alias("h"))
    rows = rows.withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int"))
    counts = {r.cell: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    pieces = json.dumps(walk(counts, shards, vnodes, CELLS, slack))
    spans = docs.sparkSession.range(1).select(F.explode(
        F.from_json(F.lit(pieces), "array<array<bigint>>")).alias("p")).select(
        F.col("p")[0].cast("int").alias("cell"), F.col("p")[1].alias("first"),
        F.col("p")[2].alias("end"), F.col("p")[3].cast("int").alias("shard"),
        F.col("p")[4].alias("base"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("h", "doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("rank", rank.cast("long")) \
        .join(F.broadcast(spans), "cell") \
        .filter("rank >= first AND rank < end") \
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"), "cell")
