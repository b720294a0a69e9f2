"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, links verified and counted where they meet."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import read, stored
from waymark.llm.components import components
from waymark.llm.textbytes import U64, mix

#: Candidates of a rotation that probes are made of.
_RANKS = 4
#: Angles that decide links without a dot product keep this distance from the threshold.
_SLACK = 1e-6
_PAIRS = 40_000


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Hadamard matrix times the columns of x, by the fast transform."""
    n, half = x.shape[0], 1
    while half < n:
        y = x.reshape(-1, 2, half, x.shape[1])
        out = np.empty_like(y)
        np.add(y[:, 0], y[:, 1], out=out[:, 0])
        np.subtract(y[:, 0], y[:, 1], out=out[:, 1])
        x = out.reshape(x.shape)
        half *= 2
    return x


class Polytopes:
    """tables hash functions of `parts` rotations each. A rotation is three rounds of random signs and a Hadamard transform; its hash is the
    nearest vertex of the cross-polytope, i.e. the largest coordinate and its sign."""

    def __init__(self, width: int, tables: int, parts: int, probes: int, seed: int = 0):
        self.room = 1 << max(1, (width - 1).bit_length())
        self.tables, self.parts, self.probes = tables, parts, probes
        self.signs = np.random.default_rng(seed).integers(0, 2, (tables, parts, 3, self.room, 1)).astype(np.float32) * 2 - 1
        # Only a combination that fewer than `probes` others surely come before can be among the first.
        ranks = itertools.product(range(min(_RANKS, self.room)), repeat=parts)
        self.ranks = np.array([r for r in ranks if np.prod(np.array(r) + 1) <= probes])

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, probes): the home bucket of each table, then the next likely ones, by how much farther their vertices are."""
        wide = np.zeros((self.room, len(x)), dtype=np.float32)
        wide[: x.shape[1]] = x.T
        out = np.empty((len(x), self.tables, self.probes), dtype=np.int64)
        rank = min(_RANKS, self.room)
        for t in range(self.tables):
            key = np.full((len(x), len(self.ranks)), mix(np.array([t + 1], dtype=np.uint64))[0], dtype=np.uint64)
            cost = np.zeros(key.shape)
            for p in range(self.parts):
                turned = wide
                for s in self.signs[t, p]:
                    turned = _hadamard(turned * s)
                turned = np.ascontiguousarray(turned.T)
                size = np.abs(turned)
                top = np.argpartition(-size, rank - 1, axis=1)[:, :rank]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
                high = np.take_along_axis(size, top, 1)
                vertex = (2 * top + (np.take_along_axis(turned, top, 1) < 0)).astype(np.uint64)
                of = self.ranks[:, p]
                cost += (high[:, :1] - high)[:, of] ** 2
                key = mix(key * U64(0x9E3779B97F4A7C15) + vertex[:, of] + U64(1))
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            if best.shape[1] < self.probes:
                best = np.hstack([best, np.repeat(best[:, :1], self.probes - best.shape[1], axis=1)])
            out[:, t] = np.take_along_axis(key, best, 1).view(np.int64)
        return out


def planned(rows: int, width: int, cosine: float, probes: int, miss: float) -> tuple[int, int]:
    """(parts, tables): so many parts that buckets outnumber the probes of all rows, and so many tables that a pair right at the
    threshold is missed by all of them with a chance of `miss`, as 4000 seeded random pairs tell. More similar pairs are missed less."""
    room = 1 << max(1, (width - 1).bit_length())
    parts = 1
    while (2 * room) ** parts < probes * rows and parts < 8:
        parts += 1
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 4000, max(2, width)))
    a /= np.sqrt((a**2).sum(axis=1, keepdims=True))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.sqrt((b**2).sum(axis=1, keepdims=True))
    one = Polytopes(max(2, width), 1, parts, probes)
    u, v = (one.keys(x)[:, 0] for x in (a, cosine * a + np.sqrt(1 - cosine * cosine) * b))
    hit = float(((u[:, :1] == v) | (v[:, :1] == u)).any(axis=1).mean())
    return parts, 1 if hit > 1 - miss else int(np.ceil(np.log(miss) / np.log(1 - max(hit, 1e-3))))


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def _pairs(first: np.ndarray, last: np.ndarray, middle: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to compare, some 40,000 at a time: in groups of rows first..last-1, those before `middle` with those from there on, or
    all with each other where middle is last."""
    of = np.repeat(np.arange(len(first)), middle - first)
    left = np.arange(len(of)) - np.repeat(np.cumsum(middle - first) - middle, middle - first)
    begin = np.where(middle[of] < last[of], middle[of], left + 1)
    many = last[of] - begin
    total = np.cumsum(many)
    a = 0
    while a < len(left):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _PAIRS, side="right")))
        n = many[a:b]
        yield np.repeat(left[a:b], n), np.arange(int(n.sum())) + np.repeat(begin[a:b] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        a = b


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n things the smallest one that it reaches over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _count_links(spark: SparkSession, members: DataFrame, width: int, hashes: Polytopes, cosine: float) -> DataFrame:
    """(node, links, parent) from rows (tile, side, key, node, home, core, copies, v): for each node of a tile the rows it is linked with, and a smaller
    node of its group there.

    A pair that several buckets hold counts in one only: in the first table in which the home of one is among the other's
    probes, in the bucket that is the smaller node's home if it can be. Hashes are worked out again for that, which takes less than moving them.
    """
    shared = spark.sparkContext.broadcast(hashes)
    columns = ["node", "links", "parent"]
    table_probes = hashes.tables, hashes.probes
    known: dict[int, np.ndarray] = {}

    def hashed(names: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Keys of nodes; a task keeps those of 20,000, as a node comes up in many buckets."""
        if len(known) > 20_000:
            known.clear()
        fresh = np.array([k for k, n in enumerate(names.tolist()) if n not in known], dtype=np.int64)
        if len(fresh):
            known.update(zip(names[fresh].tolist(), shared.value.keys(x[fresh])))
        return np.array([known[n] for n in names.tolist()])

    def flush(held: list[pa.RecordBatch]):
        whole = pa.Table.from_batches(held).combine_chunks()
        tile, side, key, node, copies = (whole[c].to_numpy() for c in ("tile", "side", "key", "node", "copies"))
        home = whole["home"].to_numpy().astype(bool)
        core = whole["core"].fill_null(-1).to_numpy()
        x = _unit(_dense(whole["v"], width))
        first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        last = np.append(first[1:], len(tile))
        middle = first + np.add.reduceat((side <= 1).astype(np.int64), first)
        sound = (side[first] == 0) | ((middle > first) & (middle < last))
        first, last, middle = first[sound], last[sound], middle[sound]
        names, at = np.unique(node, return_index=True)
        number = np.searchsorted(names, node)
        links, ends, met = np.zeros(len(names), dtype=np.int64), [], []
        for a, b in _pairs(first, last, middle):
            keep = (home[a] | home[b]) & ((core[a] != core[b]) | (core[a] < 0)) & (node[a] != node[b])
            a, b = a[keep], b[keep]
            close = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
            if close.any():
                met.append((a[close], b[close]))
        if not met:
            return
        linked = np.unique(number[np.concatenate([y for ab in met for y in ab])])
        own = np.empty((len(names), *table_probes), dtype=np.int64)
        own[linked] = hashed(names[linked], x[at[linked]])
        for a, b in met:
            u, v = np.minimum(number[a], number[b]), np.maximum(number[a], number[b])
            u_home, v_home = (own[u, :, :1] == own[v]).any(axis=2), (own[v, :, :1] == own[u]).any(axis=2)
            table = (u_home | v_home).argmax(axis=1)
            row = np.arange(len(u))
            keep = np.where(u_home[row, table], own[u, table, 0], own[v, table, 0]) == key[a]
            a, b, u, v = a[keep], b[keep], u[keep], v[keep]
            np.add.at(links, number[a], copies[b])
            np.add.at(links, number[b], copies[a])
            ends.append((u, v))
        if ends:
            parent = names[_joined(len(names), *(np.concatenate(x) for x in zip(*ends)))]
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(x[found]) for x in (names, links, parent)], names=columns)

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            tile = batch.column(0).to_numpy()
            # All but the last tile, which may go on in the next batch.
            cut = int(np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))[-1]) if len(tile) else 0
            if held and (cut or tile[0] != held[-1].column(0)[-1].as_py()):
                held.append(batch.slice(0, cut))
                yield from flush([b for b in held if b.num_rows])
                held, rows = [], 0
            elif cut:
                yield from flush([batch.slice(0, cut)])
            held.append(batch.slice(cut))
            rows += batch.num_rows - cut
        if held and rows:
            yield from flush(held)

    placed = members.repartition("tile").sortWithinPartitions("tile", "side", "node").select("tile", "side", "key", "node", "home", "core", "copies", "v")
    return placed.mapInArrow(run, "node long, links long, parent long")


def _cores(entries: DataFrame, nodes: DataFrame, width: int, cosine: float) -> DataFrame:
    """(node, core): nodes of crowded buckets that are within half the threshold's angle of their bucket's mean, so that all of a core are
    linked with each other. A node takes the largest core that it can be in."""
    home = stored(entries.where("home").join(nodes.select("node", "v"), "node").select("key", "node", "v"), "homes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double")))
    means = home.withColumn("_n", norm).groupBy("key").agg(F.array(*[F.coalesce(F.sum(F.get("v", F.lit(k)).cast("double") / F.col("_n")), F.lit(0.0)) for k in range(width)]).alias("mean"))
    half = float(np.cos(np.arccos(cosine) / 2 - _SLACK))

    def near(batches):
        for batch in batches:
            mean = _dense(batch.column(3), width)
            some = np.flatnonzero(np.abs(mean).max(axis=1, initial=0) > 0)
            x, mean = _unit(_dense(batch.column(2), width)[some]), _unit(mean[some])
            keep = pa.array(some[(x * mean).sum(axis=1) >= half])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["key", "node"])

    inside = stored(home.join(means, "key").select("key", "node", "v", "mean").mapInArrow(near, "key long, node long"), "inside")
    sizes = inside.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return inside.join(sizes, "key").groupBy("node").agg(F.max(F.struct("n", "key")).alias("m")).select("node", F.col("m.key").alias("core"))


def _tiles(entries: DataFrame, tile_rows: int) -> DataFrame:
    """(tile, side, key, node, home, core): the rows of crowded buckets in tiles of two chunks, of which no core meets itself."""
    own = entries.withColumn("c", F.coalesce("core", F.lit(-1)))
    sizes = own.groupBy("key", "c").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    chunks = stored(sizes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "chunks")
    a, b = chunks.select("key", F.struct("c", "part").alias("a")), chunks.select("key", F.struct("c", "part").alias("b"))
    pairs = a.join(b, "key").where("a <= b and (a.c != b.c or a.c = -1)").withColumn("tile", F.xxhash64("key", "a", "b"))
    sides = pairs.select("tile", "key", F.when(F.col("a") < F.col("b"), 1).otherwise(0).alias("side"), "a.c", "a.part").union(pairs.where("a < b").select("tile", "key", F.lit(2), "b.c", "b.part"))
    placed = own.join(sizes, ["key", "c"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return placed.join(sides, ["key", "c", "part"]).select("tile", "side", "key", "node", "home", "core")


def near_vectors(vectors: DataFrame, cosine: float = 0.95, probes: int = 8, miss: float = 0.001, crowd: int = 256, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of vectors: what near-duplicate vectors each has, and their groups.

    Rows are linked if they share a bucket and their cosine, in double precision, is at least `cosine`; n_links counts the other rows a row is linked
    with, component_id is the smallest id reachable, kept marks the row that bears it. Hash functions are concatenated
    cross-polytope hashes after fast pseudo-random rotations; a row lives in one bucket of each table and probes the probes - 1 next likely ones. As many tables are
    made as miss a pair at the threshold with a chance of `miss`, whatever the data; no cosine below the threshold is ever linked.

    Equal vectors are one node. Buckets are found by keys and node numbers alone (16 bytes); vectors move only into
    buckets of two nodes or more, and pairs are compared where they meet: what comes out is a count and a parent for each node of a bucket, never
    pairs. A bucket of more than `crowd` nodes is first relieved of its core: nodes within half the threshold's angle of the mean,
    which are all linked, so that they are counted without a comparison. What else is crowded is cut into tiles of two chunks of `crowd` rows.

    Cases: null, empty and zero vectors and those with null or non-finite components link with nothing (n_links 0, own component), nor do rows
    with a null id (component_id null, kept true); shorter vectors count as filled up with zeros; rows that repeat an id are rows of their own, with the links of their vectors; no
    rows: none. Columns besides id_col and vector_col are not read.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.select(vector_col).dtypes)[vector_col]
    own = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), own.alias("v"))
    fine = F.forall("v", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf"))) & F.exists("v", lambda y: y != 0)
    fine = F.coalesce(fine, F.lit(False)) & F.col("vec_id").isNotNull()
    # Two digests with independent seeds tell vectors apart by 128 bits.
    rows = rows.select("vec_id", "v", F.when(fine, F.xxhash64(F.lit(1), "v")).alias("d1"), F.when(fine, F.xxhash64(F.lit(2), "v")).alias("d2"))
    usable = rows.where("d1 is not null")
    nodes = usable.groupBy("d1", "d2").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("v").alias("v"))
    facts = usable.agg(F.max(F.size("v")).alias("width"), F.count("*").alias("n")).first()
    plain = rows.select("vec_id", "d1", "d2")
    if not facts["n"]:
        return plain.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = facts["width"]
    parts, tables = planned(facts["n"], width, cosine, probes, miss)
    hashes = Polytopes(width, tables, parts, probes, seed)
    shared = spark.sparkContext.broadcast(hashes)
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def hashed(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                some = batch.slice(a, 1000)
                key = shared.value.keys(_unit(_dense(some.column(1), width)))
                n = key[0].size
                home = np.tile(np.arange(n) % probes == 0, len(key))
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1)), pa.array(np.repeat(some.column(0).to_numpy(), n)), pa.array(home)], names=["key", "node", "home"])

    hashed_rows = nodes.select("node", "v").mapInArrow(hashed, "key long, node long, home boolean")
    # A node that lists a bucket twice is in it once.
    entries = stored(hashed_rows.dropDuplicates(["key", "node"]) if probes > len(hashes.ranks) else hashed_rows, "entries")
    buckets = stored(entries.groupBy("key").agg(F.count("*").alias("members"), F.max("home").alias("lived")).where("members > 1 and lived"), "buckets")
    entries = stored(entries.join(buckets.select("key", "members"), "key"), "shared")
    crowded = F.col("members") > crowd
    some_crowded = bool(buckets.where(crowded).take(1))
    if some_crowded:
        cores = stored(_cores(entries.where(crowded), nodes, width, cosine), "cores")
        entries = stored(entries.join(cores, "node", "left"), "cored")
        tiles = _tiles(entries.where(crowded), crowd)
    else:
        entries = entries.withColumn("core", F.lit(None).cast("long"))
    calm = entries.where(~crowded).select(F.col("key").alias("tile"), F.lit(0).alias("side"), "key", "node", "home", "core")
    members = (calm.union(tiles) if some_crowded else calm).join(nodes.select("node", "copies", "v"), "node")
    counted = stored(_count_links(spark, members, width, hashes, cosine), "counted")

    links = counted.where("parent != node").select(F.col("node").alias("u"), F.col("parent").alias("v"))
    found = counted.groupBy("node").agg(F.sum("links").alias("links"))
    of = nodes.select("node", "d1", "d2", "low", "copies").join(found, "node", "left").withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1).drop("links")
    if some_crowded:
        weighed = cores.join(nodes.select("node", "copies"), "node").groupBy("core").agg(F.sum("copies").alias("total"), F.min("node").alias("head"))
        cored = cores.join(weighed, "core").select("node", "head", "total")
        links = links.union(cored.where("node != head").select("node", "head"))
        of = of.join(cored, "node", "left").withColumn("n_links", F.col("n_links") + F.coalesce(F.col("total") - F.col("copies"), F.lit(0))).drop("head", "total")
    of = stored(of.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node")), "parts")
    lowest = of.groupBy("component").agg(F.min("low").alias("component_id"))
    of = of.join(lowest, "component").select("d1", "d2", "n_links", "component_id")
    out = plain.join(of, ["d1", "d2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_polytope_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.95."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


OP11_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x != 0)) > 0),
n as (select vec_id, e, sqrt(list_dot_product(e, e)) as r from v),
links as (select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id != b.vec_id where list_dot_product(a.e, b.e) / (a.r * b.r) >= 0.95),
reach as (select vec_id as node, vec_id as root from embeddings union select l.b, r.root from reach r join links l on l.a = r.node where r.root <= l.b),
parts as (select node, min(root) as component_id from reach group by node),
many as (select a, count(*) as n_links from links group by a)
select p.node as vec_id, coalesce(n_links, 0) as n_links, component_id, node = component_id as kept from parts p left join many on a = node
"""
