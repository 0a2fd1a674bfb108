"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by a hash of their text, so that equal texts stand together.  Keys are sampled with a
probability in proportion to the record's size, and the sample's quantiles become RANGES range boundaries.
A key with more than 1/HEAVY of a shard's bytes gets a range of its own, and overfull ranges are
subdivided into parts of about PART_ROWS rows: by the id's hash where one key fills the range, by the key's hash
elsewhere, so no window has to hold a hot key.

Heavy groups of equal texts are placed first, the largest on the emptiest shard, and stay whole if that has room for them.
All other records lie on one line, on which each shard takes as many bytes as it still needs: exact sizes per part
give every part its place, a running sum inside the part gives each record its byte position (law ``bytes``:
shard sizes are near equal).  Light groups go to the shard of their middle; only a heavy group that no
shard has room for is divided, at shard borders.

What reaches the driver is bounded: the sample (about SAMPLE keys), at most HEAVY heavy keys a shard, and the sums of
the parts, a row for RANGES-th of the records or PART_ROWS of them.

Defined results: a null text counts as empty (size 1, crc32 of no bytes); ids may be null or repeated, rows are
placed one by one; ties in the order are between rows that are alike; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

from xmarket.session import written

RANGES, SAMPLE, HEAVY, PART_ROWS = 1024, 16_384, 256, 1_000_000
_MAX = (1 << 63) - 1


def _small(df: DataFrame, rows: list[dict], kind: str) -> DataFrame:
    """Rows as a local table: a literal would be written out in every plan that reads it, and in every event of the plan."""
    names = [field.split(":")[0] for field in kind.split(",")]
    table = pa.table({name: [r[name] for r in rows] for name in names}, schema=to_arrow_schema(_parse_datatype_string(kind)))
    return df.sparkSession.createDataFrame(table, kind)


def _place(df: DataFrame, key: str, bounds: list[int]) -> DataFrame:
    """Column range: how many ascending bounds are at or below the key, by a binary search in steps."""
    if not bounds:
        return df.withColumn("range", F.lit(0))
    size = 1 << len(bounds).bit_length()
    padded = _small(df, [{"bounds": bounds + [_MAX] * (size - len(bounds))}], "bounds:array<bigint>")
    names = df.columns
    df, step = df.crossJoin(F.broadcast(padded)).withColumn("range", F.lit(0)), size // 2
    while step:
        at = F.col("range") + F.lit(step)
        inside = (at <= F.lit(len(bounds))) & (F.col(key) >= F.element_at("bounds", at))
        df = df.withColumn("range", F.col("range") + F.when(inside, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return df.select(*names, "range")


def _homes(groups: dict[int, int], total: int, shards: int) -> tuple[dict[int, int], list[int]]:
    """(shard of each group that stays whole, bytes that each shard takes of the rest), the largest group first."""
    room = [total * (i + 1) // shards - total * i // shards for i in range(shards)]
    homes = {}
    for key, size in sorted(groups.items(), key=lambda g: (-g[1], g[0])):
        widest = max(range(shards), key=lambda i: (room[i], -i))
        if size <= room[widest]:
            homes[key] = widest
            room[widest] -= size
    return homes, room


def shard(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("key")
    )  # the only pass over the texts
    base = written(base, "keys")
    whole = base.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    total = max(1, whole["bytes"])

    # fewer than HEAVY groups a shard can be above this size
    heavy_rows = base.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > F.lit(total // (HEAVY * shards))).collect()
    heavy = sorted(r["key"] for r in heavy_rows)
    homes, room = _homes({r["key"]: r["bytes"] for r in heavy_rows}, total, shards)
    chance = F.col("size") * F.lit(SAMPLE / total)
    drawn = F.pmod(F.xxhash64("key", "id", F.lit("sample")), F.lit(1_000_003)) / F.lit(1_000_003.0) < chance
    sample = sorted(r["key"] for r in base.where(drawn).select("key").collect())
    bounds = {sample[len(sample) * i // RANGES] for i in range(1, RANGES)} if sample else set()
    bounds |= set(heavy) | {k + 1 for k in heavy if k < _MAX}
    bounds = sorted(bounds)

    own = {b: i + 1 for i, b in enumerate(bounds)}
    home_of = {own[k]: homes.get(k, -1) for k in heavy}
    ranged = written(_place(base, "key", bounds), "ranges")  # later plans are without the steps of the search
    counts = {r["range"]: r["rows"] for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("rows")).collect()}  # one row a range
    target = min(PART_ROWS, 1 + whole["rows"] // RANGES)
    plan = [{"range": r, "parts": 1 + (n // target if n > 2 * target else 0), "heavy": r in home_of, "home": home_of.get(r, -1)} for r, n in sorted(counts.items())]
    parts = _small(df, plan, "range:int,parts:bigint,heavy:boolean,home:int")
    seed = F.when(F.col("heavy"), F.xxhash64("id", F.lit("part"))).otherwise(F.xxhash64("key", F.lit("part")))
    dealt = ranged.join(F.broadcast(parts), "range").withColumn("part", F.pmod(seed, F.col("parts")))
    sums = dealt.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()  # a row a part
    starts, at_bytes, at_rows = [], 0, {}
    for r in sorted(sums, key=lambda r: (r["range"], r["part"])):
        home = home_of.get(r["range"], -1)
        starts.append({"range": r["range"], "part": r["part"], "at_bytes": at_bytes, "at_rows": at_rows.get(home, 0)})
        at_rows[home] = at_rows.get(home, 0) + r["rows"]
        at_bytes += r["bytes"] if home < 0 else 0
    placed = dealt.join(F.broadcast(_small(df, starts, "range:int,part:bigint,at_bytes:bigint,at_rows:bigint")), ["range", "part"])

    order = Window.partitionBy("range", "part").orderBy("key", "id", "size", "crc")
    placed = placed.withColumn("row", F.col("at_rows") + F.row_number().over(order) - 1)
    placed = placed.withColumn("at", F.col("at_bytes") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    group = Window.partitionBy("range", "part", "key").orderBy("id", "size", "crc")
    every = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    light = 2 * F.first("at").over(group) + F.sum("size").over(every)  # twice the middle of the group
    middle = F.when(F.col("heavy"), 2 * F.col("at") + F.col("size")).otherwise(light)
    borders = [2 * sum(room[: i + 1]) for i in range(shards - 1)]
    on_line = sum(((middle >= F.lit(b)).cast("int") for b in borders), F.lit(0))
    placed = placed.withColumn("shard", F.when(F.col("home") >= 0, F.col("home")).otherwise(on_line))
    line = placed.where("home < 0").groupBy("shard").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("lines"))  # a row a shard
    slot = F.when(F.col("home") >= 0, F.coalesce("lines", F.lit(0)) + F.col("row")).otherwise(F.col("row") - F.col("first"))
    return placed.join(F.broadcast(line), "shard", "left").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
