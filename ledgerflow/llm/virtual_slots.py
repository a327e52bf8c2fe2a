"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots (thousands); bytes are summed per
slot, so what decides the layout is a table of ``N_SLOTS`` numbers whatever
the size of the data.  A versioned map says which shard each slot lives on.
The first version packs slots by size; later versions are edits of the one
before that move as few slots as bring the shards' bytes level.  Records never
rehash: moving a slot moves all its records and touches no other.

Built-in functions only; the map's packing is a loop over ``N_SLOTS`` sums on
the driver, a fixed number.

Defined cases: a null text counts no bytes but the eight of its record, and
its checksum is that of an empty text; repeated rows share a slot and get
positions of their own; an empty table gives no rows and a map of empty slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slots, for the life of a data set.
N_SLOTS = 4096
#: Bytes counted for a record besides its text.
RECORD_BYTES = 8


def slot_of(*keys: str) -> Column:
    """The virtual slot of a record, by its key columns alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(N_SLOTS)).cast("int")


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` narrowed to ``id_col, vslot, size, text_crc32``."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(id_col, slot_of(id_col).alias("vslot"), (F.octet_length(raw) + F.lit(RECORD_BYTES)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))


def slot_bytes(slotted: DataFrame) -> list[int]:
    """Bytes of each slot: one combinable aggregate, N_SLOTS rows at most."""
    sums = [0] * N_SLOTS
    for row in slotted.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect():
        sums[row["vslot"]] = row["bytes"]
    return sums


def pack(sums: list[int], shards: int) -> list[int]:
    """First map: slots by falling size, each to the lightest shard so far."""
    load, at = [(0, s) for s in range(shards)], [0] * len(sums)
    for slot in sorted(range(len(sums)), key=lambda k: (-sums[k], k)):
        size, shard = heapq.heappop(load)
        at[slot] = shard
        heapq.heappush(load, (size + sums[slot], shard))
    return level(sums, at, shards)


def level(sums: list[int], at: list[int], shards: int) -> list[int]:
    """Edit a map until no single move or swap between the heaviest shard and
    the lightest brings them closer; slots that do not move keep their shard."""
    at = list(at)
    load = [0] * shards
    members: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(at):
        load[shard] += sums[slot]
        members[shard].append(slot)
    for _ in range(4 * len(sums)):
        high, low = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        best, move = gap, None  # the smallest gap that remains, and the move
        fits = sorted((sums[k], k) for k in members[low])
        sizes = [s for s, _ in fits]
        for k in members[high]:
            if 0 < sums[k] < gap and abs(gap - 2 * sums[k]) < best:
                best, move = abs(gap - 2 * sums[k]), (k, None)
            want = sums[k] - gap // 2
            lo, hi = 0, len(sizes)
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if sizes[mid] < want else (lo, mid)
            for j in (lo - 1, lo):
                if 0 <= j < len(fits) and 0 < sums[k] - sizes[j] < gap and abs(gap - 2 * (sums[k] - sizes[j])) < best:
                    best, move = abs(gap - 2 * (sums[k] - sizes[j])), (k, fits[j][1])
        if move is None:
            break
        k, other = move
        members[high].remove(k)
        members[low].append(k)
        at[k] = low
        if other is not None:
            members[low].remove(other)
            members[high].append(other)
            at[other] = high
        shift = sums[k] - (sums[other] if other is not None else 0)
        load[high] -= shift
        load[low] += shift
    return at


def grow(sums: list[int], at: list[int], shards: int) -> list[int]:
    """Edit a map of ``shards`` shards for one more: the new shard takes slots
    from the heaviest shards until it holds its share; no other slot moves."""
    at, load = list(at), [0] * (shards + 1)
    members: list[list[int]] = [[] for _ in range(shards + 1)]
    for slot, shard in enumerate(at):
        load[shard] += sums[slot]
        members[shard].append(slot)
    share = sum(sums) // (shards + 1)
    for m in members:
        m.sort(key=lambda k: (sums[k], k))
    heavy = [(-load[s], s) for s in range(shards) if members[s]]
    heapq.heapify(heavy)
    while heavy and load[shards] < share:
        _, s = heapq.heappop(heavy)
        fit = next((k for k in reversed(members[s]) if load[shards] + sums[k] <= share), None)
        if fit is None:
            continue
        members[s].remove(fit)
        load[s] -= sums[fit]
        load[shards] += sums[fit]
        at[fit] = shards
        if members[s]:
            heapq.heappush(heavy, (-load[s], s))
    return at


def map_frame(spark: SparkSession, at: list[int], sums: list[int], version: int) -> DataFrame:
    """A map version as rows ``version, vslot, shard, bytes``."""
    def column(values: list[int], kind: str) -> Column:
        text = F.lit(",".join(map(str, values)))
        return F.element_at(F.split(text, ","), F.col("id").cast("int") + 1).cast(kind)

    return spark.range(len(at)).select(F.lit(version).alias("version"), F.col("id").cast("int").alias("vslot"), column(at, "int").alias("shard"), column(sums, "bigint").alias("bytes"))


def write_map(spark: SparkSession, path: str, at: list[int], sums: list[int], version: int) -> DataFrame:
    """Store a version beside the ones before; a version is never rewritten."""
    target = f"{path}/version={version}"
    map_frame(spark, at, sums, version).drop("version").coalesce(1).write.mode("errorifexists").parquet(target)
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int, bytes bigint").parquet(f"{path}/version={version}")


def assign(slotted: DataFrame, slot_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``slotted`` with ``shard`` and ``position``, which counts from 0 without
    gaps within a shard.

    Rows are numbered within buckets of a slot, and buckets within a shard
    start where the ones before end; both sides of the sum are narrow, and the
    windows run per bucket and over bucket counts.
    """
    rows = slotted.join(F.broadcast(slot_map.select("vslot", "shard")), "vslot")  # N_SLOTS rows
    rows = rows.withColumn("bucket", F.pmod(F.crc32(F.concat_ws(":", F.col(id_col).cast("string"), F.col("text_crc32").cast("string"))), F.lit(16)).cast("int"))
    rows = rows.withColumn("within", F.row_number().over(Window.partitionBy("vslot", "bucket").orderBy(id_col, "text_crc32", "size")) - 1)
    counts = rows.groupBy("shard", "vslot", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("vslot", "bucket")) - F.col("n")
    return rows.join(counts.select("vslot", "bucket", before.alias("base")), ["vslot", "bucket"]).withColumn("position", (F.col("base") + F.col("within")).cast("long")).drop("base", "within", "bucket")
