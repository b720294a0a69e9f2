"""Hard negatives by inner product, from R-trees packed by sort-tile-recursive."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import read, stored
from waymark.llm.forest import past_all_trees
from waymark.llm.mtree import _lists, _matrix, quantized

#: Scores are longs; the smallest one stands for none, and larger ones than a long holds are cut to the largest.
_NONE, _MOST = -(1 << 63), (1 << 63) - 1
_EXACT = float(1 << 53)
_FANOUT = 16


class RTree:
    """Pages of at most `page` rows and nodes of at most 16 children, each with the smallest box around its vectors and its range of labels.

    Packed by sort-tile-recursive: rows are cut into slabs by label, each slab by the coordinate of largest variance, and so on. A page's
    rows are a slice of the arrays; kids of a node are a slice of the nodes, which are numbered from the root down. computed counts scores.
    """

    _ARRAYS = ("ids", "labels", "vectors", "low", "high", "label_low", "label_high", "first", "last", "leaf")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def pack(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, page: int) -> RTree:
        order = cls._tiles(labels, vectors, page)
        pages = [(a, min(a + page, b)) for a, b in order[1] for a in range(a, b, page)]
        rows = order[0]
        ids, labels, vectors = ids[rows], labels[rows], vectors[rows]
        at = np.array([a for a, _ in pages])
        levels = [(np.minimum.reduceat(vectors, at), np.maximum.reduceat(vectors, at), np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at), at, np.array([b for _, b in pages]))]
        while len(levels[-1][0]) > 1:
            low, high, l_low, l_high, *_ = levels[-1]
            at = np.arange(0, len(low), _FANOUT)
            levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(l_low, at), np.maximum.reduceat(l_high, at), at, np.minimum(at + _FANOUT, len(low))))
        # Nodes from the root down: a level's kids start where the next level does.
        levels.reverse()
        starts = np.cumsum([len(x[0]) for x in levels])
        whole = [np.concatenate(x) for x in zip(*[(*x[:4], x[4] + (starts[k] if k + 1 < len(levels) else 0), x[5] + (starts[k] if k + 1 < len(levels) else 0), np.full(len(x[0]), k + 1 == len(levels))) for k, x in enumerate(levels)])]
        return cls(dict(zip(cls._ARRAYS, (ids, labels, vectors, *whole))))

    @staticmethod
    def _tiles(labels: np.ndarray, vectors: np.ndarray, page: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Rows in packed order, and the slices of it that pages don't cross."""
        axes = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable")
        order, slices, done = np.argsort(labels, kind="stable"), [], 0
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        if len(cuts) >= max(1, len(labels) // page):
            cuts = cuts[:0]
        wait = [(x, 0) for x in np.split(order, cuts)][::-1]
        out = []
        while wait:
            rows, depth = wait.pop()
            pages = -(-len(rows) // page)
            if pages <= 1 or depth == len(axes):
                out.append(rows)
                slices.append((done, done + len(rows)))
                done += len(rows)
                continue
            slabs = int(np.ceil(pages ** (1 / (len(axes) - depth))))
            rows = rows[np.argsort(vectors[rows, axes[depth]], kind="stable")]
            size = -(-pages // slabs) * page
            wait += [(rows[a : a + size], depth + 1) for a in range(0, len(rows), size)][::-1]
        return np.concatenate(out), slices

    def dump(self) -> bytes:
        """All arrays, vectors and boxes in the narrowest type that holds them."""
        out, largest = io.BytesIO(), int(np.abs(self.vectors).max(initial=0))
        narrow = next((t for t in (np.int8, np.int16, np.int32) if 0 <= largest <= np.iinfo(t).max), np.int64)
        np.savez(out, **{a: getattr(self, a).astype(narrow) if a in ("vectors", "low", "high") else getattr(self, a) for a in self._ARRAYS})
        return out.getvalue()

    @classmethod
    def undump(cls, data: bytes) -> RTree:
        with np.load(io.BytesIO(data)) as z:
            return cls({a: z[a].astype(np.int64) if a in ("vectors", "low", "high") else z[a] for a in cls._ARRAYS})


class Windows:
    """Score windows of a block of anchors: for each, the k best rows whose score lies within it and whose label is the anchor's (same) or another.

    of: the anchor of each window, ascending; least and most: its bounds, both included.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, of: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.exact, self.of, self.k, self.same = ids, labels, vectors, of, k, same
        self.plain = vectors.astype(np.float64)
        self.up, self.down = np.maximum(self.plain, 0), np.minimum(self.plain, 0)
        self.size = np.abs(self.plain).sum(axis=1)
        self.least, self.most = least, most
        self.score = np.full((len(of), k), _NONE, dtype=np.int64)
        self.found = np.full((len(of), k), _MOST, dtype=np.int64)
        self.computed = 0

    def bar(self, rows: np.ndarray) -> np.ndarray:
        """Scores that a further result must reach: the window's least one, or the k-th so far, where ties may still win by id."""
        return np.maximum(self.least[rows], self.score[rows, -1])

    def _boxes(self, anchors: np.ndarray, tree: RTree, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner products of anchors with the boxes of nodes a..b-1: each coordinate's interval, summed up."""
        low, high = tree.low[a:b].astype(np.float64), tree.high[a:b].astype(np.float64)
        up, down = self.up[anchors], self.down[anchors]
        most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
        widest = np.maximum(np.abs(low), np.abs(high)).max(initial=0)
        if widest * self.size[anchors].max(initial=0) >= _EXACT:
            slack = 1e-9 * self.size[anchors][:, None] * widest
            most, least = most + slack, least - slack
        return least, most

    def _open(self, rows: np.ndarray, least: np.ndarray, most: np.ndarray, tree: RTree, node: np.ndarray) -> np.ndarray:
        """Which boxes may hold a result: not those outside the window, strictly below the k-th, or of the wrong labels only."""
        label = self.labels[self.of[rows]]
        low, high = tree.label_low[node], tree.label_high[node]
        fits = (low <= label) & (label <= high) if self.same else (low != label) | (high != label)
        return fits & (most >= self.bar(rows)) & (least <= self.most[rows])

    def visit(self, tree: RTree) -> None:
        """Best-first: each window takes the pages by the highest score that they allow, all windows a step at a time, until none can add to it."""
        every = np.arange(len(self.of))
        wait, leaves, upper = [(0, 1, every)], [], []
        while wait:
            a, b, rows = wait.pop()
            anchors, back = np.unique(self.of[rows], return_inverse=True)
            least, most = self._boxes(anchors, tree, a, b)
            for node in range(a, b):
                hit = self._open(rows, least[back, node - a], most[back, node - a], tree, np.array([node]))
                own = rows[hit]
                if not len(own):
                    continue
                if tree.leaf[node]:
                    column = np.full(len(self.of), -np.inf)
                    column[own] = most[back[hit], node - a]
                    leaves.append(node)
                    upper.append(column)
                else:
                    wait.append((int(tree.first[node]), int(tree.last[node]), own))
        if not leaves:
            return
        upper = np.array(upper).T
        order = np.argsort(-upper, axis=1, kind="stable")
        going = every
        for step in range(len(leaves)):
            leaf = order[going, step]
            high = upper[going, leaf]
            keep = (high > -np.inf) & (high >= self.bar(going))
            going, leaf = going[keep], leaf[keep]
            if not len(going):
                break
            by = np.argsort(leaf, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                self._page(tree, leaves[leaf[group[0]]], going[group])

    def _page(self, tree: RTree, node: int, rows: np.ndarray) -> None:
        a, b = tree.first[node], tree.last[node]
        anchors, back = np.unique(self.of[rows], return_inverse=True)
        x = tree.vectors[a:b]
        self.computed += len(anchors) * len(x)
        if np.abs(x).max(initial=0) * self.size[anchors].max(initial=0) < _EXACT:
            s = np.rint(self.plain[anchors] @ x.astype(np.float64).T).astype(np.int64)
        else:
            s = np.clip(self.exact[anchors].astype(object) @ x.astype(object).T, -_MOST, _MOST).astype(np.int64)
        other = tree.labels[a:b] != self.labels[anchors][:, None]
        s = np.where((other != self.same) & (tree.ids[a:b] != self.ids[anchors][:, None]), s, _NONE)[back]
        s = np.where((s >= self.bar(rows)[:, None]) & (s <= self.most[rows][:, None]), s, _NONE)
        better = np.flatnonzero((s != _NONE).any(axis=1))
        if not len(better):
            return
        rows, s = rows[better], s[better]
        every, names = np.hstack([self.score[rows], s]), np.hstack([self.found[rows], np.broadcast_to(tree.ids[a:b], s.shape)])
        best = np.lexsort((names, ~every), axis=1)[:, : self.k]
        self.score[rows], self.found[rows] = np.take_along_axis(every, best, axis=1), np.take_along_axis(names, best, axis=1)


def forest(rows: DataFrame, width: int, n: int, tree_rows: int, page: int) -> DataFrame:
    """(tree) from (vec_id, label, v): slabs by label and the coordinate of largest variance, cut into trees of at most tree_rows rows.

    Slabs are ranges with the id as the last key, so that neither a label nor a vector that many rows share makes one too large.
    """
    spread = rows.agg(*[F.var_pop(F.get("v", F.lit(k))).alias(str(k)) for k in range(width)]).first()
    axis = max(range(width), key=lambda k: (spread[k] or 0.0, -k))
    keys = [F.col("label"), F.get("v", F.lit(axis)), F.col("vec_id")]

    def build(batches):
        held, size = [], 0

        def closed():
            ids, labels, m = (np.concatenate(x) for x in zip(*[(b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2), width)) for b in held]))
            return pa.RecordBatch.from_arrays([pa.array([RTree.pack(ids, labels, m, page).dump()], pa.binary())], names=["tree"])

        for batch in batches:
            a = 0
            while a < batch.num_rows:
                part = batch.slice(a, tree_rows - size)
                held.append(part)
                size, a = size + part.num_rows, a + part.num_rows
                if size == tree_rows:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    slabs = max(1, -(-n // (tree_rows * 8)), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // tree_rows)))
    ranged = rows.select("vec_id", "label", "v").repartitionByRange(slabs, *keys).sortWithinPartitions(*keys)
    return stored(ranged.mapInArrow(build, "tree binary"), "rtrees")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, tree_rows: int = 4096, page: int = 64, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of every anchor row and each of its positives.

    vector_col holds longs, label_col an integer. A row's score is its inner product with the anchor. An anchor's positives are the rows of its label
    with the highest scores, its own id apart; for each the first `negatives` rows of other labels are given whose score is from low % to high % of the
    positive's. Higher scores come first, ties by smaller id.

    Rows are packed into R-trees of at most tree_rows rows. Anchors go past all of them twice: for their positives, then with a score window for each
    positive. A box gives an interval of each coordinate's product, so of the score: boxes outside the window, strictly below the k-th result, or of
    the wrong label are left out, others searched best-first. Nothing is missed, whatever is pruned; where boxes tell little this is the exact scan in pages.

    Cases: rows with a null id, label or vector, or a null component, take no part; shorter vectors count as filled up with zeros; an anchor without other rows of
    its label has no positives, and a positive of negative score no negatives; equal anchor rows are one anchor, and rows that repeat an id are
    candidates each; scores beyond a long are cut to the nearest one; no rows: none. Columns besides these are not read.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<long>").alias("v"), is_anchor.alias("asks"))
    rows = rows.where("vec_id is not null and label is not null and v is not null and forall(v, x -> x is not null)")
    facts = rows.agg(F.max(F.size("v")).alias("width"), F.count("*").alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    width = max(1, facts["width"])
    trees = forest(rows, width, facts["n"], tree_rows, page)
    anchors = stored(rows.where("asks").select("vec_id", "label", "v").distinct().withColumn("q", F.monotonically_increasing_id()), "anchors")

    def searched(queries: DataFrame, k: int, same: bool) -> DataFrame:
        """(q, w, vec_id, score): the k best of each window w of queries, from every group of trees."""

        class Block:
            def __init__(self, t: pa.Table):
                t = t.combine_chunks()
                self.q = t["q"].to_numpy()
                count = np.array([1] * len(self.q)) if same else np.diff(t["least"].combine_chunks().offsets.to_numpy())
                of = np.repeat(np.arange(len(self.q)), count)
                bounds = (np.full(len(of), b, dtype=np.int64) for b in (-_MOST, _MOST)) if same else (t[c].combine_chunks().flatten().to_numpy() for c in ("least", "most"))
                self.place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                self.windows = Windows(t["vec_id"].to_numpy(), t["label"].to_numpy(), _matrix(t["v"].combine_chunks(), width), of, *bounds, k, same)
                self.visit = self.windows.visit

            def results(self):
                w = self.windows
                at, place = np.nonzero(w.score != _NONE)
                for a in range(0, len(at), 50_000):
                    i, j = at[a : a + 50_000], place[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.q[w.of[i]], self.place[i], w.found[i, j], w.score[i, j])], names=["q", "w", "vec_id", "score"])

        found = past_all_trees(trees, queries, RTree.undump, Block, "q long, w long, vec_id long, score long")
        order = Window.partitionBy("q", "w").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = stored(searched(anchors, positives, True), "positives")
    # The window's bounds as whole scores: the least at or above low %, the largest at or below high %.
    share = lambda p, f: f(F.col("score").cast("decimal(38,0)") * F.lit(p) / F.lit(100)).cast("long")
    own = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), "score", share(low, F.ceil).alias("least"), share(high, F.floor).alias("most")))).alias("own"))
    asked = stored(anchors.join(own, "q").select("q", "vec_id", "label", "v", "own", F.col("own.least").alias("least"), F.col("own.most").alias("most")), "windows")
    found = searched(asked.select("q", "vec_id", "label", "v", "least", "most"), negatives, False)
    out = found.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(asked.select("q", F.col("vec_id").alias("anchor_id"), "own"), "q").withColumn("p", F.get("own", F.col("w").cast("int")))
    return out.select("anchor_id", F.col("p.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id", F.col("p.score").alias("positive_score"), "negative_score")


def op13_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 50, against all others; every seventh row's label is one up."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = read(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), quantized(F.col("embedding"), 256).alias("vector"))
    return hard_negatives(table, F.col("vec_id") % 50 == 0)


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score from v a join v b on a.vec_id != b.vec_id where a.vec_id % 50 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= 3
"""
