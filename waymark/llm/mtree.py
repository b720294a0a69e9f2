"""Exact top-k by inner product over a forest of M-trees."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import read, stored
from waymark.llm.forest import past_all_trees

#: Slack of floating-point bounds, times the norms at hand; scores themselves are exact integers.
_SLACK = 1e-6
#: Scores are longs; the smallest one stands for none, and larger ones than a long holds are cut to the largest.
_NONE, _MOST = -(1 << 63), (1 << 63) - 1
_EXACT = float(1 << 53)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with one more component, so that all have the norm `top`.

    The Euclidean distance of a query (with 0 there) to them is then
    sqrt(|q|**2 + top**2 - 2 * q.x): the nearest has the largest inner product.
    """
    extra = np.sqrt(np.maximum(top * top - (x.astype(np.float64) ** 2).sum(axis=1), 0))
    return np.hstack([x.astype(np.float64), extra[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of each of a to the one b."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _far_apart(points: np.ndarray, n: int, first: int = 0) -> list[int]:
    """At most n different points, each the farthest from those before it."""
    chosen, nearest = [first], None
    while len(chosen) < n:
        d = _distances(points, points[chosen[-1]])
        nearest = d if nearest is None else np.minimum(nearest, d)
        if not nearest.max() > 0:
            break
        chosen.append(int(nearest.argmax()))
    return chosen


class Wanted:
    """A block of queries, and the k best found so far for each; worst: scores below it may be left out."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, top: float, worst: np.ndarray | None = None):
        self.ids, self.k, self.top, self.exact = ids, k, top, vectors
        self.plain = vectors.astype(np.float64)
        self.square = (self.plain**2).sum(axis=1)
        self.norm = np.sqrt(self.square)
        self.slack = _SLACK * (top + self.norm)
        self.wide = top * self.norm.max(initial=0) >= _EXACT
        self.score = np.full((len(ids), k), _NONE, dtype=np.int64)
        self.found = np.full((len(ids), k), _MOST, dtype=np.int64)
        self.low = np.full(len(ids), _NONE, dtype=np.int64) if worst is None else worst.astype(np.int64)

    def least(self, rows: np.ndarray) -> np.ndarray:
        """Scores that a result must reach, as doubles a little below."""
        low = self.low[rows]
        return np.where(low == _NONE, -np.inf, low - _SLACK * self.norm[rows] * self.top)

    def bound(self, rows: np.ndarray) -> np.ndarray:
        """Distances beyond which nothing is a result."""
        return np.sqrt(np.maximum(0.0, self.square[rows] + self.top**2 - 2.0 * self.least(rows))) + self.slack[rows]

    def scores(self, rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Inner products of queries with vectors: sums of integers, exact in doubles below 2**53, else as Python's integers."""
        if not self.wide:
            return np.rint(self.plain[rows] @ x.astype(np.float64).T).astype(np.int64)
        return np.clip(self.exact[rows].astype(object) @ x.astype(object).T, -_MOST, _MOST).astype(np.int64)

    def offer(self, rows: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """Take the scores s of queries rows and the entries ids; an entry of the query's own id is none."""
        s = np.where((s < self.low[rows][:, None]) | (ids == self.ids[rows][:, None]), _NONE, s)
        better = np.flatnonzero((s != _NONE).any(axis=1))
        if not len(better):
            return
        rows, s = rows[better], s[better]
        every, names = np.hstack([self.score[rows], s]), np.hstack([self.found[rows], np.broadcast_to(ids, s.shape)])
        best = np.lexsort((names, ~every), axis=1)[:, : self.k]
        self.score[rows], self.found[rows] = np.take_along_axis(every, best, axis=1), np.take_along_axis(names, best, axis=1)
        self.low[rows] = np.maximum(self.low[rows], self.score[rows, -1])


class MTree:
    """Paged metric tree. A node has a routing vector, covering radii and the distance to its parent's.

    Leaves hold their entries' distances to the leaf's routing vector. Loaded in bulk: a page that
    is too large is split around routing vectors far from each other. radius covers the augmented
    vectors, ball the plain ones. computed counts the distances and scores worked out so far.
    """

    _ARRAYS = ("ids", "vectors", "routing", "radius", "ball", "parent_distance", "kids_at", "kids", "rows_at", "entries", "entry_distance")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        self.size = (self.routing**2).sum(axis=1)
        self.computed = 0

    @classmethod
    def load(cls, ids: np.ndarray, vectors: np.ndarray, top: float, page: int) -> MTree:
        points = _augmented(vectors, top)
        plain = points[:, :-1]
        nodes: list[tuple] = []
        kids: list[list[int]] = []
        wait: list[tuple[np.ndarray, np.ndarray, int]] = [(np.arange(len(ids)), points[0], -1)]
        while wait:
            rows, routing, parent = wait.pop()
            if parent >= 0:
                kids[parent].append(len(nodes))
            far = _distances(points[rows], routing)
            leaf = len(rows) <= page or far.max() == 0
            order = np.argsort(far, kind="stable") if leaf else rows[:0]
            up = 0.0 if parent < 0 else float(np.sqrt(((routing - nodes[parent][0]) ** 2).sum()))
            nodes.append((routing, far.max(), _distances(plain[rows], routing[:-1]).max(), up, rows[order], far[order]))
            kids.append([])
            if leaf:
                continue
            own = points[rows]
            chosen = _far_apart(own, min(16, max(2, -(-len(rows) // page))), int(far.argmin()))
            to = np.stack([_distances(own, own[c]) for c in chosen]).argmin(axis=0)
            wait += [(rows[to == j], own[c], len(nodes) - 1) for j, c in enumerate(chosen)]
        at = [np.concatenate([[0], np.cumsum([len(x) for x in own])]) for own in (kids, [n[4] for n in nodes])]
        flat = {"kids_at": at[0], "kids": np.array([x for own in kids for x in own], dtype=np.int64), "rows_at": at[1], "entries": np.concatenate([n[4] for n in nodes]), "entry_distance": np.concatenate([n[5] for n in nodes])}
        first = {name: np.array([n[j] for n in nodes], dtype=np.float64) for j, name in enumerate(("routing", "radius", "ball", "parent_distance"))}
        return cls({"ids": ids, "vectors": vectors, **first, **flat})

    def dump(self) -> bytes:
        """All arrays, vectors in the narrowest type that holds them."""
        out, largest = io.BytesIO(), int(np.abs(self.vectors).max(initial=0))
        narrow = next((t for t in (np.int8, np.int16, np.int32) if 0 <= largest <= np.iinfo(t).max), np.int64)
        np.savez(out, **{a: getattr(self, a).astype(narrow) if a == "vectors" else getattr(self, a) for a in self._ARRAYS})
        return out.getvalue()

    @classmethod
    def undump(cls, data: bytes) -> MTree:
        with np.load(io.BytesIO(data)) as z:
            return cls({a: z[a] for a in cls._ARRAYS} | {"vectors": z["vectors"].astype(np.int64)})

    def _leaves(self, w: Wanted) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Leaves that some query may need; for each query their highest possible scores (-inf: ruled out) and distances.

        A child is first held against the stored distance to its parent, and only for the queries left is its own distance
        computed. The highest possible score is the lower one of what the metric's radius and the ball allow.
        """
        n, found, upper, far = len(w.ids), [], [], []
        wait = [(0, np.arange(n))]
        while wait:
            node, rows = wait.pop()
            dot = w.plain[rows] @ self.routing[node, :-1]
            self.computed += len(rows)
            d = np.sqrt(np.maximum(0.0, w.square[rows] + self.size[node] - 2.0 * dot))
            low = np.maximum(0.0, d - self.radius[node] - w.slack[rows])
            high = np.minimum((w.square[rows] + w.top**2 - low * low) / 2.0, dot + w.norm[rows] * self.ball[node]) + _SLACK * w.norm[rows] * w.top
            keep = high >= w.least(rows)
            rows, d, high = rows[keep], d[keep], high[keep]
            if not len(rows):
                continue
            kids = self.kids[self.kids_at[node] : self.kids_at[node + 1]]
            if not len(kids):
                found.append(node)
                column = np.full((2, n), -np.inf)
                column[0, rows], column[1, rows] = high, d
                upper.append(column[0])
                far.append(column[1])
                continue
            bound = w.bound(rows)
            for kid in kids:
                own = rows[np.abs(d - self.parent_distance[kid]) - self.radius[kid] <= bound + w.slack[rows]]
                if len(own):
                    wait.append((int(kid), own))
        return found, np.array(upper).T.reshape(n, -1), np.array(far).T.reshape(n, -1)

    def search(self, w: Wanted) -> None:
        """Best-first: each query takes its leaves by the highest score they allow, all queries a step at a time, and is
        done when the next one can't reach its k-th so far. Only what can't be among the k best is passed over."""
        if not len(self.ids) or not len(w.ids):
            return
        leaves, upper, far = self._leaves(w)
        order = np.argsort(-upper, axis=1)
        going = np.arange(len(w.ids))
        for step in range(len(leaves)):
            leaf = order[going, step]
            high = upper[going, leaf]
            keep = (high > -np.inf) & (high >= w.least(going))
            going, leaf = going[keep], leaf[keep]
            if not len(going):
                break
            by = np.argsort(leaf, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                own = leaf[group[0]]
                self._page(leaves[own], going[group], far[going[group], own], w)

    def _page(self, node: int, rows: np.ndarray, d: np.ndarray, w: Wanted) -> None:
        """A leaf's entries: those whose stored distance rules them out for a query aren't compared with it."""
        a, b = self.rows_at[node], self.rows_at[node + 1]
        near = np.abs(d[:, None] - self.entry_distance[a:b]) <= (w.bound(rows) + w.slack[rows])[:, None]
        columns = np.flatnonzero(near.any(axis=0))
        entries = self.entries[a:b][columns]
        near = near[:, columns]
        n = int(near.sum())
        if n * 4 < near.size and not w.wide:
            r, c = np.nonzero(near)
            s = np.full(near.shape, _NONE, dtype=np.int64)
            s[r, c] = np.rint(np.einsum("ij,ij->i", w.plain[rows[r]], self.vectors[entries[c]].astype(np.float64))).astype(np.int64)
            self.computed += n
        else:
            s = w.scores(rows, self.vectors[entries])
            self.computed += near.size
        w.offer(rows, s, self.ids[entries])


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, as a double; null if the vector or a component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.flatten().to_numpy()
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    if (lengths == width).all():
        return flat.reshape(-1, width).copy() if len(lengths) else out
    for i, n in enumerate(lengths):
        out[i, :n] = flat[offsets[i] - offsets[0] : offsets[i] - offsets[0] + n]
    return out


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.reshape(-1)))


def _cell_of(split: dict[int, tuple[np.ndarray, int]], points: np.ndarray) -> np.ndarray:
    """Cells of points: from node 0 on, each goes to the nearest pivot of a node that is split, whose number is the node's first child's and up."""
    cell = np.zeros(len(points), dtype=np.int64)
    for node, (pivots, first) in split.items():
        rows = np.flatnonzero(cell == node)
        if len(rows):
            cell[rows] = first + ((pivots**2).sum(axis=1) - 2 * points[rows] @ pivots.T).argmin(axis=1)
    return cell


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, bucket_rows: int = 4096, max_pivots: int = 4096, sample: int = 8192, page: int = 128, block: int = 8192, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for every query row, those of its own id apart.

    vector_col holds longs. Rows go to the nearest pivot; pivots are points of a sample of at most `sample` rows that are far
    from each other, and a pivot with more than bucket_rows rows is split by further pivots of its own rows, until there
    are max_pivots. What is crowded even then (one vector many times, say) is cut by row numbers. So no bucket grows
    with the data. Every bucket becomes an M-tree, written as one row of arrays, and is searched at once for the
    queries among its rows, which bounds their k-th scores from near neighbours.

    Trees and queries then meet in a grid of tasks (past_all_trees), in one job: a task holds a group of trees, queries stream
    past them `block` at a time and keep the k best so far, which bound the next tree. What moves is each tree once a slice of
    131,072 queries, each query once a group of 32 trees, and at most k rows a query and group back, those above the bound
    of its own bucket. Nothing is gathered or broadcast but pivots. Where nothing can be ruled out this is the exact scan in blocks.

    Cases: vectors or ids that are null take no part; shorter vectors count as filled up with zeros; equal rows
    are candidates each (ties between them, and between ids, go to the smaller id), and one query; an id with different
    vectors is a query for each; scores beyond a long are cut to the nearest one; fewer candidates than k
    give all; no rows: none. Columns besides id_col and vector_col are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<long>").alias("v"), is_query.alias("is_query")).where("vec_id is not null and v is not null")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("top"), F.count("*").alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, top = max(1, facts["width"]), float(np.sqrt(facts["top"])) * (1 + 1e-12) + 1e-9

    def celled() -> DataFrame:
        shared = spark.sparkContext.broadcast(dict(split))

        def run(batches):
            for batch in batches:
                m = _matrix(batch.column(1), width)
                cell = _cell_of(shared.value, _augmented(m, top))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(m), batch.column(2), pa.array(cell)], names=["vec_id", "v", "is_query", "cell"])

        return rows.mapInArrow(run, "vec_id long, v array<long>, is_query boolean, cell long")

    split, made, counts, settled = {}, 1, {0: facts["n"]}, set()
    while crowded := [c for c, m in counts.items() if m > bucket_rows and c not in settled]:
        room = (max_pivots - made) // len(crowded)
        if room < 2:
            break
        each = max(2, sample // len(crowded))
        first = Window.partitionBy("cell").orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v")
        placed = celled().where(F.col("cell").isin(crowded))
        pool = placed.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= each).select("cell", "v").orderBy("cell", "_n").toArrow()
        at, points = pool["cell"].to_numpy(), _augmented(_matrix(pool["v"].combine_chunks(), width), top)
        for c in crowded:
            own = points[at == c]
            chosen = _far_apart(own, min(room, 64, max(2, -(-2 * counts[c] // bucket_rows))))
            if len(chosen) < 2:
                settled.add(c)
            else:
                split[c] = own[chosen], made
                made += len(chosen)
        before, counts = counts, {r["cell"]: r["n"] for r in celled().groupBy("cell").agg(F.count("*").alias("n")).collect()}
        # A cell that keeps nearly all rows of the one it is split from isn't split any more.
        settled |= {c for p, (pivots, first) in split.items() if p in before for c in range(first, first + len(pivots)) if counts.get(c, 0) > 0.9 * before[p]}

    parts = F.element_at(F.create_map(*[F.lit(x) for c, m in counts.items() for x in (c, -(-m // bucket_rows))]), F.col("cell"))
    bucketed = celled().withColumn("bucket", F.concat_ws(":", "cell", F.pmod(F.monotonically_increasing_id(), parts))).drop("cell")

    def build(batches):
        """A row for each bucket's tree, and one for each query of the bucket with its k-th score there."""
        held: list[pa.RecordBatch] = []

        def closed():
            ids, m, asks = (np.concatenate(x) for x in zip(*[(b.column(0).to_numpy(), _matrix(b.column(1), width), b.column(2).fill_null(False).to_numpy(zero_copy_only=False)) for b in held]))
            tree = MTree.load(ids, m, top, page)
            yield pa.RecordBatch.from_arrays([pa.array([tree.dump()], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64())], names=names)
            if asks.any():
                w = Wanted(ids[asks], m[asks], k, top)
                tree.search(w)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(w.ids), pa.binary()), pa.array(w.ids), _lists(m[asks]), pa.array(w.low)], names=names)

        names = ["tree", "vec_id", "v", "worst"]
        for batch in batches:
            own = np.array(batch.column(3).to_pylist(), dtype=object)
            cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and held[0].column(3)[0].as_py() != own[a]:
                    yield from closed()
                    held.clear()
                held.append(batch.slice(a, b - a))
        if held:
            yield from closed()

    built = stored(bucketed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(build, "tree binary, vec_id long, v array<long>, worst long"), "trees")
    trees = built.where("tree is not null").select("tree")
    asked = built.where("tree is null").groupBy("vec_id", "v").agg(F.max("worst").alias("worst"))
    asked = stored(asked.withColumn("q", F.monotonically_increasing_id()), "queries")

    class Block:
        """Queries and what the trees visited so far gave them; the k-th scores bound the next tree."""

        def __init__(self, t: pa.Table):
            self.q = t["q"].to_numpy()
            self.w = Wanted(t["vec_id"].to_numpy(), _matrix(t["v"].combine_chunks(), width), k, top, t["worst"].to_numpy())

        def visit(self, tree: MTree) -> None:
            tree.search(self.w)

        def results(self):
            w = self.w
            for a in range(0, len(self.q), 5000):
                at, place = np.nonzero(w.score[a : a + 5000] != _NONE)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.q[a + at], w.ids[a + at], w.found[a + at, place], w.score[a + at, place])], names=["q", "query_id", "vec_id", "score"])

    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    best = past_all_trees(trees, asked, MTree.undump, Block, "q long, query_id long, vec_id long, score long", block=block).withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 20, against all others."""
    table = read(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding")).alias("vector"))
    return top_k(table, F.col("vec_id") % 20 == 0)


OP4_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * x::double) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v::double[], c.v::double[]) as bigint) as score from v q join v c on q.vec_id != c.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 20
"""
