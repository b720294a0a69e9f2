"""Exact quantiles of groups of any size, by counting bits instead of gathering values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.shared import written

_STEP = 16


def _ordered(values: np.ndarray) -> np.ndarray:
    """Longs in the order of the doubles."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], settled: int = 4096, upper: bool = False) -> DataFrame:
    """(keys, n, one column for each of shares): exact quantiles of a double by group, linear between neighbours (upper: the larger neighbour); n counts values.

    A double's bits, read as an ordered long, are looked at 16 at a time: counts by the bits so far tell which values of 16 more
    bits hold the wanted places, and only rows that share those go on, until at most `settled` rows are left for each place, which are
    numbered. So a group is never sorted or held as a whole, however large; counts are summed before they are shuffled. Each
    round is a grouped count and an equi-join on a table that is smaller each time, four rounds at most.

    Cases: nulls and NaN are no values; a group without values gives no row; null keys are a group; -0.0 counts as 0.0; no rows: none.
    """
    names = list(shares)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema) if keys else ""
    own = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))

    def run(batches):
        for batch in batches:
            v = batch.column(batch.num_columns - 1).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_ordered(v))], names=[*batch.schema.names, "_b"])

    rows = written(own.mapInArrow(run, ", ".join(x for x in (kinds, "_v double, _b long") if x)), "values")
    rows = rows.select((F.struct(*keys) if keys else F.struct(F.lit(0))).alias("_key"), "_v", "_b")
    totals = rows.groupBy("_key").agg(F.count("*").alias("n"))
    wanted = None
    for name in names:
        at = F.lit(float(shares[name])) * (F.col("n") - 1)
        for end in (F.floor(at), F.ceil(at)):
            one = totals.select("_key", F.lit(name).alias("_name"), end.cast("long").alias("_place"))
            wanted = one if wanted is None else wanted.unionByName(one)
    # Each wanted place, with how many values its prefix leaves before it.
    goals = written(wanted.distinct().withColumn("_left", F.col("_place")).withColumn("_head", F.lit(0).cast("long")), "goals")
    found = None
    left = rows.withColumn("_head", F.lit(0).cast("long"))
    for depth in range(1, 64 // _STEP + 1):
        shift = 64 - depth * _STEP
        finer = left.withColumn("_next", F.shiftright("_b", shift))
        counts = finer.groupBy("_key", "_head", "_next").agg(F.count("*").alias("_n"), F.min("_b").alias("_lo"), F.max("_b").alias("_hi"), F.min("_v").alias("_least"))
        before = Window.partitionBy("_key", "_head").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        hit = goals.join(counts, ["_key", "_head"]).where((F.col("_left") >= F.col("_before")) & (F.col("_left") < F.col("_before") + F.col("_n")))
        hit = written(hit.select("_key", "_name", "_place", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_next").alias("_head"), "_n", (F.col("_lo") == F.col("_hi")).alias("_one"), "_least"), "bins")
        done = hit.where("_one").select("_key", "_name", "_place", F.col("_least").alias("_v"))
        found = done if found is None else found.unionByName(done)
        goals = hit.where("not _one").select("_key", "_name", "_place", "_left", "_head", "_n")
        largest = goals.agg(F.max("_n")).first()[0]
        goals = goals.drop("_n")
        if largest is None:
            break
        keep = goals.select("_key", "_head").distinct()
        left = finer.drop("_head").withColumnRenamed("_next", "_head").join(keep, ["_key", "_head"], "left_semi")
        if largest <= settled:
            numbered = left.withColumn("_left", F.row_number().over(Window.partitionBy("_key", "_head").orderBy("_b")) - 1)
            last = goals.join(numbered, ["_key", "_head", "_left"]).select("_key", "_name", "_place", "_v")
            found = found.unionByName(last)
            break
        left = written(left, "left")
    ends = found.groupBy("_key").pivot("_name", names).agg(F.min(F.struct("_place", "_v")).alias("lo"), F.max(F.struct("_place", "_v")).alias("hi"))
    out = ends.join(totals, "_key")
    columns = []
    for name in names:
        at = F.lit(float(shares[name])) * (F.col("n") - 1)
        lo, hi = F.col(f"`{name}_lo`"), F.col(f"`{name}_hi`")
        if upper:
            columns.append(hi["_v"].alias(name))
            continue
        columns.append(F.when(lo["_place"] == hi["_place"], lo["_v"]).otherwise((hi["_place"] - at) * lo["_v"] + (at - lo["_place"]) * hi["_v"]).alias(name))
    return out.select(*(["_key.*"] if keys else []), "n", *columns)
