"""Two-pass external shuffle into shards of equal row counts.

Pass 1 scatters the records by a seeded hash into buckets that fit in memory. Pass 2 puts
each bucket into random order by Spark's ``shuffle``, which is Fisher and Yates' algorithm
with a seed, and writes it. The buckets one after the other are the random order of all
records; it is cut into shards whose counts differ by one at most (law ``rows``).

The text moves once, from the scan to its bucket. The size of every bucket is counted
before, from hashes alone, so a bucket knows where it begins and writes whole shards.

Rows that repeat id and text have one hash. Where they would fill a bucket, they are counted
instead, and each copy gets a hash of its own on its way to the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import shared_folder, stored

SHARDS = 16
SEED = 20_240_229
#: Bytes of text in a bucket, on the mean; a bucket is put into order in memory by one task.
#: Where tasks have more memory than a gigabyte, larger buckets make fewer tasks.
BUCKET_BYTES = 16_000_000
#: Buckets summed up in one step, and whose beginnings may be broadcast (16 bytes each).
BLOCK, BROADCAST_BUCKETS = 4096, 500_000
#: What a row takes beside its text, about, where it is asked if repeats fill a bucket.
ROW_BYTES = 100


def size_of(text: Column) -> Column:
    """Bytes in UTF-8 plus 1; null has none."""
    return F.octet_length(F.coalesce(text.cast("string"), F.lit(""))).cast("long") + 1


def scatter_key(text: Column, doc_id: Column, seed: int) -> Column:
    """Uniform for rows that differ in id or text."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def _weight() -> Column:
    return (F.sum("bytes") + ROW_BYTES * F.count(F.lit(1))).alias("weight")


def repeated_keys(keyed: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """Stored ``(key)`` of the rows that repeat id and text and weigh more than ``limit``.

    Only buckets that are too heavy are looked into. There are fewer such keys than buckets.
    """
    full = counts.where(F.col("weight") > 2 * limit).select("bucket")
    if full.isEmpty():
        return full.select(F.lit(0).cast("long").alias("key")).limit(0)
    keys = keyed.join(F.broadcast(full), "bucket", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n"), _weight())
    return stored(keys.where((F.col("n") > 1) & (F.col("weight") > limit)).select("key"), "repeated_keys")


def spread(keyed: DataFrame, repeated: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``keyed`` with a new key and bucket for each row whose key is ``repeated``.

    Rows that are equal in all columns are counted before they are shuffled, and made again
    from their number, some thousands in a row, so no task gets all of them.
    """
    keys = F.broadcast(repeated) if buckets <= BROADCAST_BUCKETS else repeated
    rest = keyed.join(keys, "key", "left_anti")
    counted = keyed.join(keys, "key", "left_semi").groupBy("key", "bytes", "record").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "repeats")
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("lot")
    lots = counted.select("bytes", "record", "n", lots).repartition("record", "lot")
    last = F.least(F.col("n"), (F.col("lot") + 1) * BLOCK) - 1
    copies = lots.select("bytes", "record", F.explode(F.sequence(F.col("lot") * BLOCK, last)).alias("copy"))
    copies = copies.withColumn("key", F.xxhash64(F.lit(seed), "record", "copy")).withColumn("bucket", _bucket(buckets))
    return rest.unionByName(copies.drop("copy"))


def _bucket(buckets: int) -> Column:
    return F.pmod("key", F.lit(buckets)).cast("int")


def _bucket_counts(keyed: DataFrame) -> DataFrame:
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), _weight())
    return stored(counts.withColumn("block", F.floor(F.col("bucket") / BLOCK)), "bucket_counts")


def shuffled_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    text: str = "text",
    doc_id: str = "doc_id",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write all rows in seeded random order and return them as read back from the shards.

    The result has ``shard`` (0 to ``shards`` - 1), ``slot`` (from 0, without gaps in a
    shard) and ``record``, a struct of all columns of ``docs``, whatever their names. It is
    written as Parquet below ``shard=<n>`` in the shared folder. The order depends on the rows
    and the seed alone, not on how the input is split. Null ids and null texts are ordinary
    values. An empty table gives empty shards, and a shard may be empty if there are fewer
    rows. Rows that repeat both id and text fall into one bucket as long as they are a small
    part of it, and are spread over all beyond; skew of ids, sources or texts doesn't matter.
    """
    spark = docs.sparkSession
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        scatter_key(F.col(text), F.col(doc_id), seed).alias("key"),
        size_of(F.col(text)).alias("bytes"),
    )
    total, rows = packed.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(shards, -(-total // bucket_bytes))
    keyed = packed.withColumn("bucket", _bucket(buckets))
    counts = _bucket_counts(keyed)
    repeated = repeated_keys(keyed, counts, max(bucket_bytes, (total + ROW_BYTES * rows) // buckets))
    if not repeated.isEmpty():
        keyed = spread(keyed, repeated, buckets, seed)
        counts = _bucket_counts(keyed)

    # Where each bucket begins, in two steps, so that no task gets the counts of all buckets.
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", F.sum("n").over(before.orderBy("block")).alias("block_start"))
    inside = F.sum("n").over(before.partitionBy("block").orderBy("bucket"))
    starts = counts.withColumn("inside", inside).join(blocks, "block")
    start = F.coalesce("block_start", F.lit(0)) + F.coalesce("inside", F.lit(0))
    starts = starts.select("bucket", start.alias("start"))
    if buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)

    # One bucket for each task: hashing bucket numbers once more would bring several into one.
    scattered = keyed.select("bucket", "key", "record").repartitionById(buckets, F.col("bucket"))
    in_memory = (
        scattered.sortWithinPartitions("bucket", "key")  # the same order when a task runs again
        .groupBy("bucket")
        .agg(F.collect_list("record").alias("records"))
        .join(starts, "bucket")
    )
    dealt = in_memory.select("start", F.posexplode(F.shuffle("records", F.lit(seed))).alias("place", "record"))
    place = (F.col("start") + F.col("place")).alias("place")
    shard = F.expr(f"cast(place * {shards} div {max(rows, 1)} as int)").alias("shard")
    first = F.ceil(F.expr(f"cast(shard as bigint) * {rows} / cast({shards} as decimal(20,0))"))
    placed = dealt.select(place, "record").select("place", shard, "record")
    placed = placed.select("shard", (F.col("place") - first).cast("long").alias("slot"), "record")
    path = shared_folder(spark, "shards")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
