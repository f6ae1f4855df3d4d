"""Operator 8: sharding by fixed virtual slots.

A record's slot is a hash of its doc_id and text into SLOTS virtual slots, which
never changes. Of equal rows (doc_id and text) every further TOGETHER go to the slot
of their own that the hash with their number gives, so a row that a third of the
table repeats is spread like others, by the same rule at every size.

Bytes and rows are summed for each slot (SLOTS rows at most), and a versioned
slot-to-shard map places slots so that shards hold near-equal bytes. The map is a
small Parquet table in a folder for each version (vslot, shard, bytes, rows). A call
that finds a map in its folder edits it: slots leave shards that are gone or over
the mean, all others stay, and the edited map is stored as the next version.

Positions: equal rows are counted before they move, numbered inside their virtual
slot (one of thousands, each about as large) by running sums, and shifted by the rows
of the slots before it in the shard, so no window spans a shard or follows a hot row.
All work is DataFrame functions.

Defined cases: null text has size 1 and crc32 0; null doc_id hashes as a value
of its own; repeated rows each get a position; ties go by content; a very long text
makes its slot, and so its shard, as heavy as it is; an empty table gives no rows and
a map without slots; other columns are ignored in ``shard`` and kept in
``shard_stage`` but for ``shard``, which it gives anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

SLOTS, SHARDS, TOGETHER = 8192, 16, 64
#: Parts of TOGETHER rows that one row is taken apart into at a time.
PARTS = 4096
MAP_SCHEMA = "vslot int, shard int, bytes long, rows long"


def _keys(doc_id: str, text: str):
    """Two hashes of a row's doc_id and text; nulls are values of their own."""
    known, content = F.coalesce(F.col(doc_id).cast("string"), F.lit("\\N")), F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(known, content), F.xxhash64(content, known, F.lit(8))


def slot_of(h, part):
    return F.pmod(F.xxhash64(h, part), F.lit(SLOTS)).cast("int")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, hashes and number of equal rows, for each different row; texts go no further."""
    h, h2 = _keys("doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (common.text_bytes("text") + 1).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), h.alias("_h"), h2.alias("_h2"))
    return rows.groupBy("doc_id", "size", "text_crc32", "_h", "_h2").agg(F.count(F.lit(1)).alias("_times"))


def in_parts(rows: DataFrame) -> DataFrame:
    """Adds _part, _here (rows of the part) and _vslot: TOGETHER equal rows at a time."""
    one = rows.where(F.col("_times") <= TOGETHER).withColumns({"_part": F.lit(0).cast("long"), "_here": F.col("_times")})
    last = F.floor((F.col("_times") - 1) / TOGETHER)
    far = rows.where(F.col("_times") > TOGETHER).withColumn("_far", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(PARTS).cast("long"))))
    many = far.withColumn("_part", F.explode(F.sequence("_far", F.least(last, F.col("_far") + PARTS - 1)))).drop("_far")
    many = many.withColumn("_here", F.least(F.lit(TOGETHER).cast("long"), F.col("_times") - F.col("_part") * TOGETHER))
    return one.unionByName(many).withColumn("_vslot", slot_of(F.col("_h"), F.col("_part")))


def place(loads: dict[int, int], shards: int, fixed: dict[int, int] | None = None) -> dict[int, int]:
    """Slots to shards: largest first to the least loaded; ``fixed`` slots stay where they are."""
    import heapq

    out = dict(fixed or {})
    held = [0] * shards
    for slot, k in out.items():
        held[k] += loads.get(slot, 0)
    heap = [(held[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(loads, key=lambda s: (-loads[s], s)):
        if slot not in out:
            load, shard = heapq.heappop(heap)
            out[slot] = shard
            heapq.heappush(heap, (load + loads[slot], shard))
    return out


def rebalance(current: dict[int, int], loads: dict[int, int], shards: int) -> dict[int, int]:
    """The map edited for ``shards`` shards and new loads: a shard keeps slots, in an order of their own, as far as
    they fit under the mean; slots that don't, or whose shard is gone, fill up the least loaded ones."""
    if not loads:
        return {s: k for s, k in current.items() if k < shards}
    mean = sum(loads.values()) / shards
    kept: dict[int, int] = {}
    filled = [0] * shards
    for slot in sorted(current, key=lambda s: (s * 2654435761 % (1 << 32), s)):
        shard = current[slot]
        if shard < shards and filled[shard] + loads.get(slot, 0) <= mean:
            kept[slot] = shard
            filled[shard] += loads.get(slot, 0)
    return place(loads, shards, kept)


def stored_map(spark, folder: str) -> tuple[int, dict[int, int]]:
    """(version, slot to shard) of the latest version in the folder; (0, {}) where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A version counts once its table is whole.
    names = [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []
    versions = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    if not versions:
        return 0, {}
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/v{max(versions)}").collect()  # SLOTS rows at most
    return max(versions), {r["vslot"]: r["shard"] for r in rows}


def store_map(spark, folder: str, version: int, mapping: dict[int, int], loads: dict[int, tuple[int, int]]) -> None:
    rows = [(slot, shard, *loads.get(slot, (0, 0))) for slot, shard in sorted(mapping.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/v{version}")


def edited_map(spark, folder: str, parts: DataFrame, shards: int) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """(slot to shard, bytes and rows of each slot) for rows (_vslot, size, _here): the stored map edited, and stored again."""
    sums = parts.groupBy("_vslot").agg(F.sum(F.col("size") * F.col("_here")).alias("bytes"), F.sum("_here").alias("rows"))
    loads = {r["_vslot"]: (r["bytes"], r["rows"]) for r in sums.collect()}  # SLOTS rows at most
    weights = {s: b for s, (b, _) in loads.items()}
    version, current = stored_map(spark, folder)
    mapping = rebalance(current, weights, shards) if version else place(weights, shards)
    if mapping != current or not version:
        store_map(spark, folder, version + 1, mapping, loads)
    return mapping, loads


def shard(docs: DataFrame, shards: int = SHARDS, map_folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot of every row; law ``bytes``.

    ``map_folder`` holds the versions of the map; without one the map is new.
    """
    spark = docs.sparkSession
    work = common.Workspace(spark, "sharding")
    parts = work.save(in_parts(measured(docs)), "parts")
    mapping, loads = edited_map(spark, map_folder or work.path("slot_map"), parts, shards)
    first: dict[int, int] = {}
    table = []
    for slot in sorted(loads):
        k = mapping[slot]
        table.append((slot, k, first.get(k, 0)))
        first[k] = first.get(k, 0) + loads[slot][1]
    placed = spark.createDataFrame(table, "_vslot int, shard int, _first long")
    inside = Window.partitionBy("_vslot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "_h", "_h2", "_part")
    numbered = parts.withColumn("_until", F.sum("_here").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    each = numbered.withColumn("_n", F.explode(F.sequence(F.col("_until") - F.col("_here"), F.col("_until") - 1)))
    # The map has at most SLOTS rows of 16 bytes: a fixed bound, so it may be broadcast.
    return each.join(F.broadcast(placed), "_vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_first") + F.col("_n")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_vslot").alias("vslot"),
    )


def shard_stage(spark, docs: DataFrame, sf_dir: str, shards: int = SHARDS, map_folder: str | None = None) -> DataFrame:
    """Pipeline stage: every row with its shard (in place of a column of that name); texts stay where they are.

    A row's part is 0 unless more than TOGETHER equal rows exist; those count by their place in the read, so the same
    input is dealt the same way.
    """
    work = common.Workspace(spark, "shard_stage")
    seen = work.save(measured(docs), "measured")
    rows = docs.drop("shard")
    slot, h, h2, far, shard_ = common.unused(rows, "_slot", "_h", "_h2", "_far", "shard")
    many = seen.where(F.col("_times") > TOGETHER).select(F.col("_h").alias(h), F.col("_h2").alias(h2), F.ceil(F.col("_times") / TOGETHER).alias(far))
    k, k2 = _keys("doc_id", "text")
    part = F.lit(0).cast("long")
    held = rows.withColumns({h: k, h2: k2})
    if many.limit(1).count():
        held = held.join(many, [h, h2], "left")
        part = F.coalesce(F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.col(far)), F.lit(0).cast("long"))
    mapping, _ = edited_map(spark, map_folder or work.path("slot_map"), in_parts(seen), shards)
    placed = spark.createDataFrame(sorted(mapping.items()), f"`{slot}` int, `{shard_}` int")
    return held.withColumn(slot, slot_of(F.col(h), part)).join(F.broadcast(placed), slot).select(*common.columns(rows), F.col(shard_).alias("shard"))
