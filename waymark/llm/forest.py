"""Trees meet queries: every query past every tree of a forest, in one job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Search(Protocol):
    def visit(self, tree) -> None:
        """Take what one tree has."""

    def results(self) -> Iterator[pa.RecordBatch]: ...


def past_all_trees(trees: DataFrame, queries: DataFrame, load: Callable[[bytes], object], begin: Callable[[pa.Table], Search], schema: str, per_group: int = 32, per_slice: int = 131_072, block: int = 8192) -> DataFrame:
    """Rows that begin(queries).results() gives after visits to trees, for every cell of a grid of tree groups and query slices.

    trees: (tree binary), a stored table; queries: any columns with a unique long `q`, a stored table. The grid's cells are the tasks: a cell has some
    `per_group` trees, which it holds, and `per_slice` queries at most, which stream past them `block` at a time. So neither side is gathered or
    broadcast, no step waits for another, and a tree or query moves once for each cell of its row or column. Fewer trees make
    smaller groups, so that all cores have work. Results of a query come from each group of trees: merging them is the caller's.
    """
    spark = trees.sparkSession
    n_trees, n_queries = trees.count(), queries.count()
    groups = max(1, -(-n_trees // per_group), min(n_trees, spark.sparkContext.defaultParallelism))
    slices = max(1, -(-n_queries // per_slice))
    cells = groups * slices
    names = [f for f in queries.columns]

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = trees.select("tree", F.pmod(F.xxhash64("tree"), F.lit(groups)).cast("int").alias("_g")).withColumn("_s", every(slices))
    right = queries.select("*", F.pmod(F.xxhash64("q"), F.lit(slices)).cast("int").alias("_s")).withColumn("_g", every(groups))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_cell", F.col("_g") * slices + F.col("_s"))
    dealt = both.repartitionById(min(cells, 50_000), F.col("_cell")).sortWithinPartitions("_cell", F.col("tree").isNull()).select("_cell", "tree", *names)

    def run(batches):
        cell, held, asked = None, [], []

        def answered():
            if asked and held:
                found = begin(pa.Table.from_batches(asked).select(names))
                for tree in held:
                    found.visit(tree)
                yield from found.results()
            asked.clear()

        for batch in batches:
            at, bodies = batch.column(0).to_pylist(), batch.column(1)
            a = 0
            while a < len(at):
                if at[a] != cell:
                    yield from answered()
                    cell, held = at[a], []
                if bodies[a].is_valid:
                    held.append(load(bodies[a].as_py()))
                    a += 1
                    continue
                b = a
                while b < len(at) and at[b] == cell and b - a < block:
                    b += 1
                asked.append(batch.slice(a, b - a))
                if sum(x.num_rows for x in asked) >= block:
                    yield from answered()
                a = b
        yield from answered()

    return dealt.mapInArrow(run, schema)
