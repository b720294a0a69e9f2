"""Benchmark decontamination: prefix-filtered containment join of item windows against whole documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import arrow_map, column_at, read, stored
from waymark.llm.textbytes import _POSITION, ALNUM, U64, Words, mix, words


@dataclass
class Index:
    """Distinct windows of a block of items, as flat arrays: some tens of bytes a window.

    Window i has n[i] words from word first[i] on, whose bytes, joined by blanks, are body[byte[first]:...]. It is in
    the items owner[owner_at[i]:owner_at[i + 1]], numbers of ids.
    """

    ids: list[str]
    body: np.ndarray
    byte: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    n: np.ndarray
    owner_at: np.ndarray
    owner: np.ndarray


def _gram(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words, one for each start."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * _POSITION[0]
    for k in range(1, size):
        out += hashes[k : k + n] * _POSITION[k]
    return mix(out)


def _hash_of(h: np.ndarray, first: np.ndarray, n: np.ndarray, base: int) -> np.ndarray:
    """A hash of the runs of n words from first on."""
    out = n.astype(np.uint64)
    for k in range(int(n.max(initial=0))):
        has = n > k
        out[has] = out[has] * U64(base) + h[first[has] + k]
    return mix(out)


_BASES = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _index(ids: list[str], texts: list[str | None], window: int) -> Index:
    number = {x: i for i, x in enumerate(dict.fromkeys(ids))}
    of = np.array([number[x] for x in ids], dtype=np.int64)
    hashes, bodies, lengths, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w in words(pa.array(texts, pa.string()), ALNUM):
        long = w.end - w.start
        inner = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        body = np.full(int((long + 1).sum()), 32, dtype=np.uint8)
        body[np.repeat(np.cumsum(long + 1) - long - 1, long) + inner] = w.lowered[np.repeat(w.start, long) + inner]
        hashes.append(w.hash)
        bodies.append(body)
        lengths.append(long)
        counts.append(np.diff(w.first_word))
    h, body, long, count = (np.concatenate(x) for x in (hashes, bodies, lengths, counts))
    own = np.where(count > 0, np.maximum(1, count - window + 1), 0)
    row = np.repeat(np.arange(len(count)), own)
    first = (np.cumsum(count) - count)[row] + np.arange(len(row)) - (np.cumsum(own) - own)[row]
    n = np.minimum(count[row], window)
    one, two = (_hash_of(h, first, n, b) for b in _BASES)
    # Windows of equal words (128 bits) are one; each of its items counts once.
    order = np.lexsort((of[row], two, one))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    item = of[row][order]
    fresh = new.copy()
    fresh[1:] |= item[1:] != item[:-1]
    lead = order[new]
    owner_at = np.append(np.flatnonzero(new[fresh]), fresh.sum())
    return Index(list(number), body, np.append(np.cumsum(long + 1) - long - 1, len(body)), h, first[lead], n[lead].astype(np.int64), owner_at, item[fresh])


def _runs(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles within rows, and their starts."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(w.first_word) - 1), np.diff(w.first_word))
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    return _gram(w.hash, size)[at], at


def _blocks(benchmark: DataFrame, limit: int):
    """The items in blocks of at most limit bytes (one item at least), streamed to the driver."""
    ids, texts, size = [], [], 0
    for row in benchmark.orderBy("item").toLocalIterator():
        n = len((row.text or "").encode())
        if ids and size + n > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.item)
        texts.append(row.text)
        size += n
    if ids:
        yield ids, texts


def _prober(docs: DataFrame, index: Index, size: int):
    """A function of a text column that gives, for runs of rows, the words, each row's ranges hit and items found.

    docs has a column text, in all rows of which the tokens are counted.
    """
    spark = docs.sparkSession
    short = np.minimum(index.n, size)
    wanted, grams = {}, {}
    for n in np.unique(short).tolist():
        grams[n] = _gram(index.hash, n)
        own = short == n
        most = int(index.n[own].max()) - n + 1
        wanted[n] = np.unique(np.concatenate([grams[n][index.first[own & (index.n - n >= k)] + k] for k in range(most)]))
    tokens = spark.sparkContext.broadcast(wanted)

    def count(batches):
        found = {n: np.zeros(len(v), np.int64) for n, v in tokens.value.items()}
        for batch in batches:
            for w in words(batch.column(0), ALNUM):
                for n, known in tokens.value.items():
                    h, _ = _runs(w, n)
                    k = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    found[n] += np.bincount(k[known[k] == h], minlength=len(known))
        for n, v in found.items():
            k = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), n, np.int32)), pa.array(tokens.value[n][k].view(np.int64)), pa.array(v[k])], names=["size", "token", "n"])

    # As many rows as the block has distinct shingles, at most: 20 bytes each.
    often = {n: np.zeros(len(v), np.int64) for n, v in wanted.items()}
    if wanted:
        found = docs.select("text").mapInArrow(count, "size int, token long, n long").groupBy("size", "token").agg(F.sum("n").alias("n")).toArrow()
        at, token, total = (found[c].to_numpy() for c in ("size", "token", "n"))
        for n, v in often.items():
            v[np.searchsorted(wanted[n], token[at == n].view(np.uint64))] = total[at == n]

    # Containment of the whole window asks for every token, so the prefix is the one rarest token.
    tables = []
    for n, v in often.items():
        own = np.flatnonzero(short == n)
        first, last = index.first[own], index.n[own] - n
        rarest, place = np.full(len(own), np.iinfo(np.int64).max), np.zeros(len(own), np.int64)
        for k in range(int(last.max()) + 1):
            has = np.flatnonzero(last >= k)
            less = v[np.searchsorted(wanted[n], grams[n][first[has] + k])]
            has, less = has[less < rarest[has]], less[less < rarest[has]]
            rarest[has], place[has] = less, k
        keep = np.flatnonzero(rarest > 0)
        keep = keep[np.argsort(grams[n][first[keep] + place[keep]], kind="stable")]
        token, start = np.unique(grams[n][first[keep] + place[keep]], return_index=True)
        if len(token):
            tables.append((n, token, np.append(start, len(keep)).astype(np.int64), own[keep], place[keep].astype(np.int32)))
    # Only windows that may occur are broadcast: their words, and the items they are in.
    live = np.unique(np.concatenate([t[3] for t in tables])) if tables else np.zeros(0, np.int64)
    cut = [index.body[index.byte[f] : index.byte[f + n] - 1].tobytes() for f, n in zip(index.first[live].tolist(), index.n[live].tolist())]
    text_at = np.concatenate([[0], np.cumsum([len(x) for x in cut], dtype=np.int64)])
    owners = index.owner_at[live + 1] - index.owner_at[live]
    owner_at = np.concatenate([[0], np.cumsum(owners)])
    owner = index.owner[np.repeat(index.owner_at[live] - owner_at[:-1], owners) + np.arange(owners.sum())].astype(np.int32)
    tables = [(n, token, start, np.searchsorted(live, window).astype(np.int32), place) for n, token, start, window, place in tables]
    shared = spark.sparkContext.broadcast((tables, b"".join(cut), text_at, _hash_of(index.hash, index.first[live], index.n[live], _BASES[0]), index.n[live].astype(np.int32), owner_at, owner, index.ids))

    def probe(column: pa.Array):
        tables, body, text_at, whole, length, owner_at, owner, ids = shared.value
        for w in words(column, ALNUM):
            spans: list[list[int]] = [[] for _ in range(w.last - w.first)]
            items: list[set[str]] = [set() for _ in range(w.last - w.first)]
            for n, token, start, window, offset in tables:
                h, at = _runs(w, n)
                k = np.minimum(np.searchsorted(token, h), len(token) - 1)
                hit = np.flatnonzero(token[k] == h)
                key, at = k[hit], at[hit]
                each = start[key + 1] - start[key]
                # Candidates in runs of about a million: places of a token times the windows it leads to.
                total = np.cumsum(each)
                for a, b in _spread(total, 1 << 20):
                    some = each[a:b]
                    entry = np.repeat(start[key[a:b]] - (np.cumsum(some) - some), some) + np.arange(some.sum())
                    i = window[entry]
                    place = np.repeat(at[a:b], some)
                    row = np.searchsorted(w.first_word, place, side="right") - 1
                    first = place - offset[entry]
                    inside = np.flatnonzero((first >= w.first_word[row]) & (first + length[i] <= w.first_word[row + 1]))
                    i, first, row = i[inside], first[inside], row[inside]
                    alike = np.flatnonzero(_hash_of(w.hash, first, length[i].astype(np.int64), _BASES[0]) == whole[i])
                    for x, f, r in zip(i[alike].tolist(), first[alike].tolist(), row[alike].tolist()):
                        end = f + int(length[x])
                        if b" ".join(w.text(f, end)) == body[text_at[x] : text_at[x + 1]]:
                            lo = int(w.first_word[r])
                            spans[r] += [f - lo, end - lo]
                            items[r].update(ids[y] for y in owner[owner_at[x] : owner_at[x + 1]].tolist())
            yield w, spans, items

    return probe


def _spread(total: np.ndarray, most: int):
    """Ranges of the places of a running total, each of about `most` (one place at least)."""
    a = 0
    while a < len(total):
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + most, side="right")))
        yield a, b
        a = b


def _hits(docs: DataFrame, index: Index, size: int) -> DataFrame:
    """(row, n_words, spans, items) for each row of (row, text): ranges of words hit, as starts and ends in turn, and items found."""
    probe = _prober(docs, index, size)

    def one(batch: pa.RecordBatch):
        for w, spans, items in probe(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.first, w.last - w.first), pa.array(np.diff(w.first_word).astype(np.int64)), pa.array([_merged(s) for s in spans], pa.list_(pa.int64())), pa.array([sorted(s) for s in items], pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "items"],
            )

    return arrow_map(docs.select("row", "text"), f"row {docs.schema['row'].dataType.simpleString()}, n_words long, spans array<long>, items array<string>", one)


def _merged(spans: list[int]) -> list[int]:
    """Disjoint ascending ranges that cover the same words."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, size: int = 3, block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, items) for each row of docs.

    Words are runs of letters, digits and non-ASCII characters after A-Z are lower-cased. An item's
    windows are its runs of `window` words (all its words, if fewer but not none). A window's tokens
    are its shingles of `size` words, ordered by their count in all documents; as all must occur, the
    rarest one is the whole prefix, and only documents' places with that token are candidates. The
    token's offset bounds where the window can lie, and the words are then compared one by one.
    spans holds disjoint ranges of words hit (start, end, start, end, ...); items the sorted ids found.

    The documents are never shuffled: of a block of at most block_bytes of items, distinct shingles (8 bytes each) and
    then the windows that may occur (their words and some 40 bytes) are broadcast as flat arrays. A larger benchmark runs block by
    block, two scans each, and the blocks' ranges are merged by row.

    Cases: null or wordless texts have no words and no windows; a null item id is named `null`; rows
    that repeat an item count once; each row of docs gives a row, also if it repeats an id; no items:
    no hits; no documents: no rows. Other columns are not read.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).alias("text"))
    plain = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"))
    blocks = _blocks(items, block_bytes)
    first = next(blocks, ([], []))
    second = next(blocks, None)
    if second is None:
        return _hits(plain, _index(*first, window), size).withColumnRenamed("row", id_col)
    # Several blocks: each row gets a number, so that rows that repeat an id stay apart.
    numbered = stored(docs.select(F.struct(F.monotonically_increasing_id().alias("k"), F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text")), "numbered")
    parts = None
    for block in (first, second, *blocks):
        found = stored(_hits(numbered, _index(*block, window), size).where("size(items) > 0"), "hits")
        parts = found if parts is None else parts.union(found)
    merged = parts.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def joined(batch: pa.RecordBatch):
        yield batch.set_column(1, "spans", pa.array([_merged(x) for x in batch.column(1).to_pylist()], pa.list_(pa.int64())))

    merged = arrow_map(merged.select("row", "spans", "items"), f"row {numbered.schema['row'].dataType.simpleString()}, spans array<long>, items array<string>", joined)
    counts = _hits(numbered, _index([], [], window), size).select("row", "n_words")
    empty = F.array().cast("array<long>"), F.array().cast("array<string>")
    return counts.join(merged, "row", "left").select(F.col("row.id").alias(id_col), "n_words", F.coalesce("spans", empty[0]).alias("spans"), F.coalesce("items", empty[1]).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, size: int = 3, block_bytes: int = 16 << 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, in which no window of the benchmark occurs; the cases of contamination() hold."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).alias("text"))
    at, out = column_at(docs, text_col), docs
    for block in _blocks(items, block_bytes):
        probe = _prober(docs.select(F.col(text_col).alias("text")), _index(*block, window), size)

        def one(batch: pa.RecordBatch, probe=probe):
            for w, spans, _ in probe(batch.column(at)):
                yield batch.slice(w.first, w.last - w.first).filter(pa.array([not s for s in spans], pa.bool_()))

        out = arrow_map(out, docs.schema, one)
    return out


def n_hit(spans: str) -> Column:
    """Words in the ranges: ends less starts."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = n_hit("spans")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.encode(F.concat_ws(",", F.array_sort("items")), "UTF-8"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""
with d as (select doc_id, {_WORDS} as ws from documents),
b as (select item_id, {_WORDS} as ws from benchmark),
win as (
  select distinct item_id, list_slice(ws, i, i + least(len(ws), 10) - 1) as win, least(len(ws), 10) as n
  from (select item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) as i from b where len(ws) > 0)
), sizes as (select distinct n from win),
pos as (select doc_id, ws, unnest(generate_series(1, len(ws))) as i from d),
hits as (
  select p.doc_id, p.i, w.n, w.item_id
  from (select doc_id, i, n, list_slice(ws, i, i + n - 1) as win from pos, sizes where i + n - 1 <= len(ws)) p join win w on w.n = p.n and w.win = p.win
), words as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as k from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256 from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, len(d.ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""
