"""Proportional stratified interleaving into shards; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import read, stored

_TWO_32 = 4294967296


def _unit(*parts: Column) -> Column:
    """32 seeded random bits of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def _bucket_offsets(counts: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """_ss_before: rows (_ss_rows) of earlier buckets, for each bucket of each key. counts has a row a bucket, not a row a row."""
    w = Window.partitionBy(*keys).orderBy(bucket) if keys else Window.orderBy(bucket)
    return counts.withColumn("_ss_before", F.coalesce(F.sum("_ss_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def stratified_shards(df: DataFrame, shards: int, seed: str = "waymark", source_col: str = "source", key_col: str = "doc_id", rows_per_bucket: int = 512, max_buckets: int = 65536) -> DataFrame:
    """df with shard (0 .. shards - 1) and slot (gapless from 0 within a shard).

    Rows are shuffled within each source by a seeded hash of their key, and ranked; a row's
    fractional rank is (rank + u) / rows of the source, u a seeded constant of the source in [0, 1).
    Sorted by fractional rank (ties: source, hash, key, then the rest of the row), the sources interleave
    in proportion, and equal cuts of that order give every shard the mixture: sizes differ by one at most.

    No task sorts a source: hashes and fractional ranks are uniform, so both orders are split into
    buckets of about rows_per_bucket rows (more only beyond max_buckets buckets) whatever the sources' shares; a row's rank is the count of the
    buckets before its own, from a table of a row a bucket, plus its number within its bucket.

    Cases: a null source is a source of its own; a null key hashes as an empty one; rows that repeat
    a key are told apart by the rest of the row, and equal rows are interchangeable; no rows: none.
    Equal texts get no shard of their own: the law is that of counts, and the copies of a text spread like any other
    rows of their source. Rows of one key fall into one bucket, so the key should be (nearly) unique. A task
    sorts a bucket's keys: 512 rows, or n / 65,536 beyond 33.5 million rows (15,259 rows, some 3 MB, at 10**9). Columns of df named
    shard or slot are replaced; others are kept, whatever their names and types.
    """
    df = df.drop("shard", "slot")
    names, kinds = df.columns, [f.dataType.simpleString() for f in df.schema]
    place = {c.lower(): k for k, c in enumerate(names)}
    key_col, source_col = (f"_ss_c{place[c.lower()]}" for c in (key_col, source_col))
    df = df.toDF(*[f"_ss_c{k}" for k in range(len(names))])
    key, source = F.coalesce(F.col(key_col).cast("string"), F.lit("")), F.col(source_col).cast("string")
    # Maps have no hash of their own, but text.
    rest = [F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in zip(df.columns, kinds)]
    rows = df.select("*", F.md5(F.concat_ws(":", F.lit(seed), key)).alias("_ss_hash"), F.xxhash64(*rest).alias("_ss_rest"))
    rows = rows.withColumn("_ss_source", F.coalesce(F.concat(F.lit("s"), source), F.lit("")))
    total = df.count()
    if not total:
        return df.toDF(*names).withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    buckets = min(max_buckets, -(-total // rows_per_bucket))
    rows = rows.withColumn("_ss_b", F.expr(f"cast(conv(substring(_ss_hash, 1, 8), 16, 10) as bigint) * {buckets} div {_TWO_32}"))

    counts = rows.groupBy("_ss_source", "_ss_b").agg(F.count("*").alias("_ss_rows"))
    offsets = _bucket_offsets(counts, ["_ss_source"], "_ss_b")
    offsets = offsets.withColumn("_ss_n", F.sum("_ss_rows").over(Window.partitionBy("_ss_source"))).select("_ss_source", "_ss_b", "_ss_before", "_ss_n")
    inner = Window.partitionBy("_ss_source", "_ss_b").orderBy("_ss_hash", key_col, "_ss_rest")
    ranked = rows.withColumn("_ss_r", F.row_number().over(inner) - 1).join(offsets, ["_ss_source", "_ss_b"])
    ranked = ranked.withColumn("_ss_f", (F.col("_ss_before") + F.col("_ss_r") + _unit(F.lit(seed), F.col("_ss_source")) / F.lit(float(_TWO_32))) / F.col("_ss_n"))
    ranked = stored(ranked.withColumn("_ss_b", F.floor(F.col("_ss_f") * buckets)).drop("_ss_before", "_ss_r", "_ss_n"), "ranked")

    places = _bucket_offsets(ranked.groupBy("_ss_b").agg(F.count("*").alias("_ss_rows")), [], "_ss_b").select("_ss_b", "_ss_before")
    outer = Window.partitionBy("_ss_b").orderBy("_ss_f", "_ss_source", "_ss_hash", key_col, "_ss_rest")
    placed = ranked.withColumn("_ss_p", F.row_number().over(outer) - 1).join(places, "_ss_b").withColumn("_ss_p", F.col("_ss_before") + F.col("_ss_p"))
    shard = F.expr(f"_ss_p * {shards} div {total}")
    out = placed.withColumn("shard", shard.cast("int"))
    out = out.withColumn("slot", F.col("_ss_p") - F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
    return out.select(*df.columns, "shard", "slot").toDF(*names, "shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Texts and all, as a folder of Parquet for each shard, in slot order within a file."""
    placed = stratified_shards(df, shards, **options)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op9_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of nearly equal row counts."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    out = stratified_shards(docs, 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def crc_table() -> list[int]:
    """The table of the reflected CRC-32 polynomial."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


OP9_SQL = f"""
with h as (
  select doc_id, text, 's' || source as src, md5('waymark:' || coalesce(cast(doc_id as varchar), '')) as hash from documents
), b as (
  select doc_id, text, coalesce(src, '') as src, hash from h
), r as (
  select *, (row_number() over (partition by src order by hash, doc_id) - 1
    + cast('0x' || substr(md5('waymark:' || src), 1, 8) as bigint) / 4294967296.0::double) / count(*) over (partition by src) as f from b
), p as (
  select *, row_number() over (order by f, src, hash, doc_id) - 1 as p, count(*) over () as n from r
), q as (
  select doc_id, hex(encode(coalesce(text, ''))) as hx, cast(p * 24 // n as int) as shard, p, n from p
), t as (select [{", ".join(f"{x}::ubigint" for x in crc_table())}] as tab)
select doc_id, length(hx) // 2 + 8 as size,
  cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hx, '..'), lambda x: cast('0x' || x as ubigint))),
    lambda c, x: xor(c >> 8, tab[cast(xor(c, x) & 255 as int) + 1])), 4294967295::ubigint) as bigint) as text_crc32,
  'rows' as law, shard, p - (shard::bigint * n + 23) // 24 as slot, cast(null as int) as grown_shard
from q, t
"""
