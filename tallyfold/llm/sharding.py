"""Shards by fixed virtual slots.

Method: a record is hashed into one of ``n_slots`` virtual slots, which never change; the bytes of
each slot are added up; a versioned map sends slots to shards, and only that map is edited when the
sizes drift apart or a shard is added. The law that holds is ``bytes``: sizes are near equal.

Slots are dealt heaviest first to the lightest shard. ``grown`` edits a map for one more shard:
slots move out of shards that are above the new mean, into the new one only. ``rebalanced`` edits a
map for new sizes and moves slots out of the fullest shards only.

Defined results: a NULL text counts as one byte; a NULL ``doc_id`` hashes like any other value,
since the text and source are hashed with it; repeated rows go to the same virtual slot and shard,
each at a place of its own. An empty table gives an empty result. Other columns are ignored;
``sharded_documents`` replaces columns named ``shard`` and ``slot``.

At scale: the map has ``n_slots`` rows whatever the data, so it may pass the driver and be
broadcast. Places inside a shard are numbered per virtual slot, from the counts of the slots before
it, so no task sees a whole shard. Rows alike in id, text and source share a virtual slot however
many they are; they are numbered from per-copy-group counts in salted parts.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import ROW_HASH
from tallyfold.sources.shared import new_folder, stored

SHARDS = 16
SLOTS = 4096
PARTS = 16

MAP = "version int, virtual_slot int, shard int"


def records(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """Narrow rows: id, size, checksum, virtual slot, and the part of the slot a row is numbered in."""
    return docs.selectExpr(
        "doc_id",
        ROW_HASH,
        "bigint(coalesce(octet_length(text), 0) + 1) as size",
        "crc32(coalesce(encode(text, 'UTF-8'), x'')) as text_crc32",
        f"int(pmod(xxhash64(doc_id, text, source), {n_slots}L)) as virtual_slot",
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Bytes per virtual slot; at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.expr("sum(size) as bytes"))


def _dealt(sizes: dict[int, int], n_shards: int, n_slots: int) -> dict[int, int]:
    """Heaviest slot first, to the shard that is lightest so far; empty slots in turn."""
    loads = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for slot in sorted(range(n_slots), key=lambda slot: (-sizes.get(slot, 0), slot)):
        load, shard = heapq.heappop(loads)
        placed[slot] = shard
        heapq.heappush(loads, (load + max(1, sizes.get(slot, 0)), shard))
    return placed


def _moved(placed: dict[int, int], sizes: dict[int, int], n_shards: int, targets: list[int]) -> dict[int, int]:
    """Move slots from the fullest shard to the emptiest target while that brings the two closer."""
    placed, loads = dict(placed), [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in placed.items():
        loads[shard] += sizes.get(slot, 0)
        held[shard].append((sizes.get(slot, 0), slot))
    for slots in held:
        slots.sort()
    while True:
        full = max(range(n_shards), key=lambda shard: loads[shard])
        least = min(targets, key=lambda shard: loads[shard])
        fitting = [x for x in held[full] if 0 < x[0] < loads[full] - loads[least]]
        if full == least or not fitting:
            return placed
        best = min(fitting, key=lambda x: abs(loads[full] - loads[least] - 2 * x[0]))
        held[full].remove(best)
        held[least].append(best)
        placed[best[1]] = least
        loads[full] -= best[0]
        loads[least] += best[0]


def _sizes(rows: DataFrame) -> dict[int, int]:
    return {row.virtual_slot: row.bytes for row in slot_sizes(rows).collect()}


def _frame(spark: SparkSession, placed: dict[int, int], version: int) -> DataFrame:
    rows = [(version, slot, shard) for slot, shard in sorted(placed.items())]
    return spark.createDataFrame(rows, MAP).coalesce(1)


def first_map(rows: DataFrame, n_shards: int = SHARDS, n_slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map, from the bytes of each slot."""
    return _frame(rows.sparkSession, _dealt(_sizes(rows), n_shards, n_slots), 1)


def _edited(slot_map: DataFrame, rows: DataFrame, grow: int) -> DataFrame:
    found = slot_map.collect()  # one version: as many rows as slots
    placed = {row.virtual_slot: row.shard for row in found}
    n_shards = max(placed.values()) + 1 + grow
    targets = [n_shards - 1] if grow else list(range(n_shards))
    return _frame(rows.sparkSession, _moved(placed, _sizes(rows), n_shards, targets), found[0].version + 1)


def rebalanced(slot_map: DataFrame, rows: DataFrame) -> DataFrame:
    """Next version of a map, for the sizes as they are now."""
    return _edited(slot_map, rows, 0)


def grown(slot_map: DataFrame, rows: DataFrame) -> DataFrame:
    """Next version of a map, with one more shard; slots move into that one only."""
    return _edited(slot_map, rows, 1)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the latest by default. A version in which a slot stands twice is an error."""
    maps = spark.read.parquet(path)
    version = version or maps.agg(F.expr("max(version)")).first()[0]
    found = maps.filter(F.col("version") == version).selectExpr("int(version) as version", "virtual_slot", "shard")
    rows, slots = found.selectExpr("count(*)", "count(distinct virtual_slot)").first()
    if rows != slots:
        raise ValueError(f"version {version} of the map at {path} lists {rows} rows for {slots} slots")
    return found


def _map_at(path: str, rows: DataFrame, n_shards: int, n_slots: int) -> DataFrame:
    """The latest version of the map at ``path``; a first one is made where there is none."""
    spark = rows.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        save_map(first_map(rows, n_shards, n_slots), path)
    return load_map(spark, path)


def placed_records(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and their place in it, counted from 0 without gaps.

    Rows are numbered inside small cells (virtual slot, part); a cell starts where the cells before
    it in the same shard end. The part comes from the row's id and, for rows alike, from a number
    that spreads them.
    """
    cells = rows.withColumn("part", F.expr(f"int(pmod(xxhash64(monotonically_increasing_id(), row_hash), {PARTS}L))"))
    cells = stored(cells.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot"), "shard-cells")
    counts = cells.groupBy("shard", "virtual_slot", "part").agg(F.expr("count(*) as n"))
    before = "sum(n) over (partition by shard order by virtual_slot, part rows between unbounded preceding and 1 preceding)"
    starts = counts.selectExpr("virtual_slot", "part", f"coalesce({before}, 0L) as start")
    order = "row_number() over (partition by virtual_slot, part order by row_hash, doc_id)"
    numbered = cells.selectExpr("*", f"{order} - 1 as place")
    joined = numbered.join(starts, ["virtual_slot", "part"])
    return joined.selectExpr(
        "doc_id", "size", "text_crc32", "shard", "bigint(start + place) as slot", "virtual_slot", "row_hash"
    )


def shard(docs: DataFrame, n_shards: int = SHARDS, n_slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every document with its shard, by the latest map at ``map_path``; one is made where there is none (by default in a new shared folder)."""
    rows = stored(records(docs, n_slots), "shard-records")
    path = map_path or new_folder(docs.sparkSession, "slot-map")
    return placed_records(rows, _map_at(path, rows, n_shards, n_slots))


def sharded_documents(docs: DataFrame, n_shards: int = SHARDS, n_slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Documents with ``shard`` and ``virtual_slot``; the texts are not moved."""
    spark = docs.sparkSession
    path = map_path or new_folder(spark, "slot-map")
    rows = stored(records(docs, n_slots).select("virtual_slot", "size"), "shard-records")
    slot_map = _map_at(path, rows, n_shards, n_slots).selectExpr("virtual_slot as _slot", "shard as _shard")
    hashed = F.expr(f"int(pmod(xxhash64(doc_id, text, source), {n_slots}L))")
    joined = docs.withColumn("_hashed", hashed).join(F.broadcast(slot_map), F.expr("_hashed = _slot"))
    kept = [joined[name] for name in docs.columns if name not in ("shard", "virtual_slot")]
    return joined.select(*kept, F.expr("_shard as shard"), F.expr("_slot as virtual_slot"))
