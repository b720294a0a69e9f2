"""Near-duplicate grouping: SuperMinHash, banding, verification on full sets, union-find."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import arrow_map, column_at, read, stored
from waymark.llm.components import components
from waymark.llm.superminhash import signatures
from waymark.llm.textbytes import NON_SPACE, U64, list_of_longs, mix, shingles, words

_SIGNED = "n_shingles long, d1 long, d2 long, bands array<long>, odd array<long>"

#: Bits of an odd sketch, in words of 64.
_ODD_WORDS = 16


def _odd_sketch(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each set 1024 bits: the parity of the elements that hash there.

    Two sketches differ in at most as many bits as the sets differ in elements.
    """
    bits = np.zeros((len(offsets) - 1) * _ODD_WORDS * 64, dtype=np.int32)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    np.add.at(bits, of * (_ODD_WORDS * 64) + (mix(h ^ U64(0x0DD)) >> U64(54)).astype(np.int64), 1)
    return np.packbits((bits & 1).astype(np.uint8).reshape(-1, _ODD_WORDS * 64), axis=1).view(np.int64)


def _sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each set's values modulo 2**64."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def sign(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, odd) per row of (doc_id, text).

    d1, d2: a 128-bit digest of the shingle set; bands: a hash for each band of the signature; odd: the
    odd sketch of the set.
    """
    m = bands * rows
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
    odd = mix(np.arange(1001, 1001 + rows, dtype=np.uint64)) | U64(1)

    def one(batch: pa.RecordBatch):
        for w in words(batch.column(1), NON_SPACE):
            h, at = shingles(w, size)
            counts = np.diff(at)
            sig = signatures(h, at, m)
            cut = mix((sig.reshape(-1, bands, rows) * odd).sum(axis=2, dtype=np.uint64) + salt)
            filled = np.flatnonzero(counts > 0)
            where = np.zeros(len(counts) + 1, dtype=np.int64)
            np.cumsum(np.where(counts > 0, bands, 0), out=where[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.first, w.last - w.first), pa.array(counts.astype(np.int64)), *_digests(h, at), list_of_longs(cut[filled].reshape(-1), where), list_of_longs(_odd_sketch(h, at).reshape(-1), np.arange(len(counts) + 1) * _ODD_WORDS)],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "odd"],
            )

    return arrow_map(docs, f"doc_id long, {_SIGNED}", one)


def _digests(h: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    return [pa.array(_sum(mix(x), at).view(np.int64)) for x in (h ^ U64(0xA5A5A5A5), h + U64(0x1234567))]


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, d1, d2, n, items): digest and full set of each row of (doc_id, text), as 64-bit hashes."""

    def one(batch: pa.RecordBatch):
        for w in words(batch.column(1), NON_SPACE):
            h, at = shingles(w, size)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.last - w.first), *_digests(h, at), pa.array(np.diff(at).astype(np.int64)), list_of_longs(h, at)], names=["doc_id", "d1", "d2", "n", "items"])

    return arrow_map(docs, "doc_id long, d1 long, d2 long, n long, items array<long>", one)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose full sets have 100 * intersection >= percent * union."""
    a, b = sets.toDF("u", "n_u", "items_u"), sets.toDF("v", "n_v", "items_v")
    close = F.col("n_u") * 100 >= F.col("n_v") * percent
    both = pairs.join(a, "u").join(b, "v").where(close & (F.col("n_v") * 100 >= F.col("n_u") * percent))
    common = F.size(F.array_intersect("items_u", "items_v")).cast("long")
    return both.withColumn("both", common).where(F.col("both") * 100 >= (F.col("n_u") + F.col("n_v") - F.col("both")) * percent).select("u", "v").distinct()


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, band): the rarest shingles of each set, as many as its intersection with any partner can't do without.

    Partners share at least `percent` of a set's n shingles, so one of its n - ceil(n * percent / 100) + 1 first ones
    in any order of all shingles, here by count, is among the partner's.
    """
    items = sets.select("node", "n", F.explode("items").alias("band"))
    ranked = items.join(items.groupBy("band").agg(F.count("*").alias("often")).where("often > 1"), "band", "left")
    own = ranked.groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "band"))).alias("all"))
    least = F.expr(f"(n * {percent} + 99) div 100").cast("int")
    return own.select("node", F.explode(F.slice("all", F.lit(1), F.col("n").cast("int") - least + 1)).alias("_s")).select("node", F.col("_s.band").alias("band"))


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of nodes (band, node, part, n, odd) of a bucket but of different parts that two exact bounds leave."""
    a, b = members.alias("a"), members.alias("b")
    cond = (F.col("a.band") == F.col("b.band")) & (F.col("a.part") < F.col("b.part")) & (F.col("a.n") * 100 >= F.col("b.n") * percent) & (F.col("b.n") * 100 >= F.col("a.n") * percent)
    # |A ^ B| <= (|A| + |B|) * (100 - p) / (100 + p) says the same as the threshold, and the odd sketches differ in no more bits.
    odd = F.lit(0)
    for k in range(_ODD_WORDS):
        odd = odd + F.bit_count(F.get("a.odd", F.lit(k)).bitwiseXOR(F.get("b.odd", F.lit(k))))
    cond &= odd * (100 + percent) <= (F.col("a.n") + F.col("b.n")) * (100 - percent)
    return a.join(b, cond).select(F.col("b.node").alias("u"), F.col("a.node").alias("v")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, exact: bool = False, crowd: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of docs.

    Words are runs of non-space after A-Z are lower-cased; a document's set holds its distinct
    shingles of `size` words (the whole sequence, if shorter). Documents with
    100 * |A & B| >= percent * |A | B| are linked; component_id is the smallest id reachable, kept
    marks the document that bears it.

    Exact copies fall into one node by the digest of their sets, so a large group of copies
    costs a row each. Nodes that share a band (missed with probability (1 - 0.8**4)**32 < 1e-7
    at the threshold) are compared in two passes: with the node of their bucket that shares most
    buckets, and then, across components only, with all others of the bucket that two exact bounds, on
    sizes and on the difference of sets by odd sketches, leave. In buckets that still have more than `crowd` nodes by then only
    those are compared that share a prefix token, as in exact, which loses nothing. Every link is confirmed on full sets. Groups
    come from union-find on partitions, then star contraction.

    exact misses nothing: nodes then meet by their prefix tokens instead of bands, at the price of
    counting all shingles and sorting each set by rarity.

    Cases: null or wordless text: empty set, linked with nothing. Rows that repeat an id are
    linked, and each of their texts has its own links. A null id is never linked; its row keeps component_id null and kept true. No rows: none.
    Columns besides id_col and text_col are not read, so their names cannot clash.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(sign(docs, size, bands, rows), "signed")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    by_digest = filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("low"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd"), F.count("*").alias("copies"))
    nodes = stored(by_digest.withColumn("node", F.monotonically_increasing_id()), "nodes")
    copies = filled.select("doc_id", "d1", "d2").join(nodes.where("copies > 1").select("d1", "d2", "low"), ["d1", "d2"]).where("doc_id != low").select(F.col("doc_id").alias("u"), F.col("low").alias("v"))

    def sets_of(some: DataFrame) -> DataFrame:
        """Full sets of nodes, a row each, from the texts of the documents of their smallest ids."""
        found = shingle_sets(docs.join(some.select(F.col("low").alias("doc_id")).distinct(), "doc_id", "left_semi"), size)
        return stored(found.dropDuplicates(["d1", "d2"]).join(some, ["d1", "d2"]).select("node", "n", "items"), "sets")

    keys = nodes.select("d1", "d2", "node", "low")
    if exact:
        sets = sets_of(keys)
        banded = _prefixes(sets, percent)
    else:
        banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(banded.join(buckets, "band"), "members")
    if not exact:
        sets = sets_of(keys.join(members.select("node").distinct(), "node"))

    # The node whose buckets hold the most others is the likeliest original of a group of copies.
    support = members.groupBy("node").agg(F.sum("members").alias("support"))
    leaders = members.join(support, "node").groupBy("band").agg(F.max(F.struct("support", (-F.col("node")).alias("minus"))).alias("lead")).select("band", (-F.col("lead.minus")).alias("leader"))
    stars = members.join(leaders, "band").where("node != leader").select(F.col("leader").alias("v"), F.col("node").alias("u")).distinct()
    first = stored(_verified(stars.select("u", "v"), sets, percent), "links")

    reached = components(first)
    placed = members.select("band", "node").join(reached, "node", "left").select("band", "node", F.coalesce("component", "node").alias("part"))
    split = placed.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo != hi").select("band")
    open_ = stored(placed.join(split, "band").join(nodes.select("node", "n", "odd"), "node"), "open")
    # A bucket that is crowded even so, as by pages of one template, isn't compared as a whole: its nodes meet by their prefix tokens, which any two of a link share.
    counts = open_.groupBy("band").agg(F.count("*").alias("many"))
    crowded = stored(counts.where(F.col("many") > crowd).select("band"), "crowded")
    if crowded.take(1):
        dense = stored(open_.join(crowded, "band", "left_semi").select("node", "part", "n", "odd").dropDuplicates(["node"]), "dense")
        tokens = _prefixes(sets.join(dense.select("node"), "node", "left_semi"), percent)
        shared = tokens.groupBy("band").agg(F.count("*").alias("many")).where("many > 1").select("band")
        met = stored(tokens.join(shared, "band").join(dense, "node").select("band", "node", "part", "n", "odd"), "met")
        across = _across(open_.join(crowded, "band", "left_anti"), percent).union(_across(met, percent)).distinct()
    else:
        across = _across(open_, percent)
    second = _verified(across, sets, percent)

    # From nodes to their smallest ids: rows that repeat an id meet there, whatever their texts.
    low = nodes.select("node", "low")
    links = first.union(second).join(low.toDF("u", "_u"), "u").join(low.toDF("v", "_v"), "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    parts = components(links.union(copies)).withColumnRenamed("node", "doc_id")
    out = signed.select("doc_id", "n_shingles").join(parts, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, with all columns, less all but one document of each group of near_duplicates().

    The document that stays is that of the smallest id. Of rows that repeat an id that of the smallest JSON
    text stays; rows with a null id, which are in no group, all stay. Columns may have any name and type.
    """
    plain = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    own, text = (f"_{column_at(docs, c)}" for c in (id_col, text_col))
    found = near_duplicates(plain, id_col=own, text_col=text, **options)
    dropped = found.where("not kept").select(F.col("doc_id").alias(own)).distinct()
    left = plain.join(dropped, own, "left_anti").select(plain.columns)
    again = plain.where(F.col(own).isNotNull()).groupBy(own).count().where("count > 1").select(own)
    if again.take(1):
        whole = F.struct(*plain.columns)
        one = left.join(again, own, "left_semi").groupBy(own).agg(F.min_by(whole, F.to_json(whole)).alias("_one")).select("_one.*")
        left = left.join(again, own, "left_anti").select(plain.columns).unionByName(one)
    return left.toDF(*docs.columns)


def op10_superminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, four-word shingles, similarity 0.8."""
    return near_duplicates(read(spark, sf_dir, "documents"), size=4)


OP10_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, case when len(ws) < 4 then array_to_string(ws, ' ') else array_to_string(list_slice(ws, i, i + 3), ' ') end as sh
  from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) as i from w where len(ws) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), both_ways as (select a, b from links union select b, a from links),
reach as (
  select doc_id as node, doc_id as root from documents
  union
  select e.b, r.root from reach r join both_ways e on e.a = r.node where r.root <= e.b
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.root) as component_id, d.doc_id = min(r.root) as kept
from documents d left join n on n.doc_id = d.doc_id join reach r on r.node = d.doc_id group by d.doc_id, n.n
"""
