"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

First pass: a seeded hash of the key and the record scatters whole records into buckets that fit in memory. Second pass:
each bucket is put into a random order by Spark's ``shuffle``, which is a Fisher-Yates shuffle. Buckets one after another
are one random order of all records, and its positions are dealt out to the shards in turn, so shard sizes are at most one
record apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from riskframe.sources.writers import working_dir

#: A bucket has about so many records or bytes at most, whichever asks for more buckets.
BUCKET_ROWS, BUCKET_BYTES = 4096, 16 << 20
#: Copies of one record that fill this share of a bucket are dealt over the buckets one by one.
HEAVY_SHARE = 8
#: Copies written out by one row of the first expansion.
CHUNK = 1024


def _bytes(records: DataFrame, held: list[str]) -> F.Column:
    """About the bytes of a record: its strings and binaries, 8 for any other plain column, nested ones as JSON."""
    size = F.lit(0).cast("long")
    for c in held:
        kind, col = records.schema[c].dataType, F.col(f"`{c}`")
        if isinstance(kind, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif hasattr(kind, "elementType") or hasattr(kind, "fields"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
        else:
            size = size + 8
    return size


def external_shuffle(records: DataFrame, key: str, shards: int, seed: int = 0, bucket_rows: int = BUCKET_ROWS,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``records`` with ``shard int`` (from 0) and ``slot bigint`` (gapless from 0 in each shard).

    Shard counts differ by one record at most. One partition holds one bucket. A null key is hashed like a value; records
    of one key are spread by their other columns and equal records by the number of the copy, so no key fills a bucket;
    repeated records are all placed; columns named shard or slot are replaced; an empty table gives an empty table. The
    order depends on the records, the seed and the bucket sizes, not on how the input is laid out.
    """
    held = [c for c in records.columns if c not in ("shard", "slot")]
    rows = records.select(*[F.col(f"`{c}`") for c in held])
    size, columns = _bytes(records, held), [F.col(f"`{c}`") for c in held]
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-total["n"] // bucket_rows), -(-total["bytes"] // bucket_bytes))
    digest = F.xxhash64(*columns, F.lit(seed))
    numbered = rows.withColumn("__copy", F.lit(0).cast("long"))
    heavy = rows.groupBy(digest.alias("d")).agg(F.count("*").alias("n"), F.sum(size).alias("b")).where(
        (F.col("n") > 1) & ((F.col("n") * HEAVY_SHARE > bucket_rows) | (F.col("b") * HEAVY_SHARE > bucket_bytes))).select("d").collect()
    if buckets > 1 and heavy:  # fewer than HEAVY_SHARE to a bucket
        is_heavy = digest.isin([r["d"] for r in heavy])
        # equal records collapse before any shuffle and are written out again chunk by chunk
        counted = rows.where(is_heavy).groupBy(*columns).agg(F.count("*").alias("__n"))
        chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / CHUNK))))
        dealt = chunks.repartition(buckets, F.col("__chunk"), *columns).withColumn("__copy", F.explode(F.sequence(
            F.col("__chunk") * CHUNK, F.least((F.col("__chunk") + 1) * CHUNK, F.col("__n")) - 1)))
        numbered = rows.where(~is_heavy).withColumn("__copy", F.lit(0).cast("long")).unionByName(dealt.select(*columns, "__copy"))
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`"), digest, F.col("__copy")), F.lit(buckets)).cast("int").alias("__bucket")
    sizes = numbered.select(bucket).groupBy("__bucket").agg(F.count("*").alias("size"))
    # one row for each bucket: its first position in the order of all records
    first = sizes.select("__bucket", (F.sum("size").over(Window.orderBy("__bucket")) - F.col("size")).alias("first"))
    gathered = (
        numbered.select(bucket, F.struct(*columns).alias("record")).repartitionById(buckets, "__bucket").groupBy("__bucket")
        # sorted records make every run draw the same numbers for the same records
        .agg(F.sort_array(F.collect_list("record")).alias("records"))
        .select("__bucket", F.shuffle("records", seed).alias("records"))
    )
    shuffled = gathered.join(F.broadcast(first), "__bucket").select("first", F.posexplode("records").alias("at", "record"))
    position = F.col("first") + F.col("at")
    return shuffled.select(
        *[F.col(f"record.`{c}`") for c in held],
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"), F.floor(position / shards).cast("long").alias("slot"))


def write_shards(records: DataFrame, path: str, key: str, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write whole records as ``path/shard=K``: each bucket adds one file to each shard, its rows in slot order."""
    placed = external_shuffle(records, key, shards, seed, bucket_bytes=bucket_bytes)
    placed.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)


def placement(docs: DataFrame, shards: int = 8, seed: int = 0, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write whole documents to shards in the shared folder and tell from these files what each shard holds.

    Columns: key, size, text_crc32, law, shard, slot, grown_shard; size and text_crc32 are those of the text in the shard.
    """
    spark = docs.sparkSession
    path = f"{working_dir(spark)}/llm/{uuid.uuid4().hex}/shards"
    write_shards(docs, path, key, shards, seed)
    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in (key, text_col))
    text = F.col(f"`{text_col}`")
    return spark.read.schema(f"{held}, slot bigint, shard int").parquet(path).select(
        F.col(f"`{key}`"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
