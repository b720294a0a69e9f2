"""Periodic runs of words: sparse diagonals of earlier occurrences, extended to their ends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import arrow_map, read
from waymark.llm.sharding import crc_table
from waymark.llm.textbytes import AS_IS, NON_SPACE, Words, words

#: Words of the shortest grams whose occurrences are followed; a run of at least 12 words matches itself over six of them at least.
_BASE = 4
_SHORTEST = 12


def _slices(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ..., lengths[k] of them, for each k in turn."""
    return np.arange(int(lengths.sum())) + np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)


def _word_numbers(w: Words) -> np.ndarray:
    """Equal words have equal numbers, others don't: hashes find equal words and bytes confirm them."""
    n = len(w.hash)
    _, first, number = np.unique(w.hash, return_index=True, return_inverse=True)
    size, twin = w.end - w.start, first[number]
    if np.array_equal(size, size[twin]) and np.array_equal(w.lowered[_slices(w.start, size)], w.lowered[_slices(w.start[twin], size)]):
        return number
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(x, len(seen)) for x in w.text(0, n)), np.int64, n)


class Repeats:
    """Names of the grams of 1, 2, 4, ... words of a sequence: places k of names[level] have equal names if the 2**level
    words from there on are equal; -1 stands for a gram that is nowhere else. A gram lies within one document."""

    def __init__(self, number: np.ndarray, document: np.ndarray):
        self.n = len(number)
        self.names: list[np.ndarray] = []
        places = np.arange(self.n)
        key = document.astype(np.int64) * (int(number.max(initial=0)) + 1) + number
        while True:
            _, back, often = np.unique(key, return_inverse=True, return_counts=True)
            again = often[back] > 1
            places = places[again]
            if not len(places):
                break
            name = np.full(self.n, -1, dtype=np.int32)
            name[places] = back[again]
            self.names.append(name)
            step = 1 << (len(self.names) - 1)
            places = places[places + step < self.n]
            places = places[name[places + step] >= 0]
            key = name[places].astype(np.int64) * self.n + name[places + step]

    def extend(self, start: np.ndarray, end: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matches [start, end) with what lies lag words before, made as long as they can be."""
        start, end = start.copy(), end.copy()
        for level in range(len(self.names) - 1, -1, -1):
            name, step = self.names[level], 1 << level
            for ahead in (True, False):
                at = end if ahead else start - step
                ok = (at - lag >= 0) & (at < self.n)
                own = name[np.where(ok, at, 0)]
                ok &= (own >= 0) & (own == name[np.where(ok, at - lag, 0)])
                if ahead:
                    end += step * ok
                else:
                    start -= step * ok
        return start, end


def _diagonals(places: np.ndarray, lags: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse table's entries (a gram at a place, and again lag words before) as stretches: an entry whose
    left neighbour is on its diagonal adds a word to it, and a diagonal that isn't continued ends."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    last = np.append(new[1:], True)[: len(new)]
    return places[new], places[last] + gram, lags[new]


def _earlier(name: np.ndarray) -> np.ndarray:
    """The last earlier place of the same name, or -1."""
    places = np.flatnonzero(name >= 0)
    order = places[np.argsort(name[places], kind="stable")]
    before = np.full(len(name), -1, dtype=np.int64)
    same = name[order[1:]] == name[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    return before


def _entries(before: np.ndarray, low: int, high: int, nearest: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of at most depth earlier occurrences of each place's gram with low <= lag < high; none for a gram that
    also lies less than nearest words before."""
    place = np.flatnonzero(before >= 0)
    back = before[place]
    keep = place - back >= nearest
    place, back = place[keep], back[keep]
    found = []
    for _ in range(depth):
        lag = place - back
        hit = (lag >= low) & (lag < high)
        found.append((place[hit], lag[hit]))
        going = lag < high
        place, back = place[going], before[back[going]]
        place, back = place[back >= 0], back[back >= 0]
        if not len(place):
            break
    return tuple(np.concatenate(x) for x in zip(*found))


def _touching(r: Repeats, runs: np.ndarray) -> np.ndarray:
    """(start, end, lag) of matches between two long runs of one period that meet or overlap, as in ababa ababa: every
    shift of one against the other by whole periods matches, and may be a run of its own."""
    start, end, period = runs[(runs[:, 1] - runs[:, 0] >= 4 * runs[:, 2])].T
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    k = np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1]))
    if not len(k):
        return np.zeros((0, 3), dtype=np.int64)
    s1, e1, s2, e2, p = start[k], end[k], start[k + 1], end[k + 1], period[k]
    # Where the second one's first words, at least a period of them, lie in the last places of the first one.
    level = np.ceil(np.log2(p)).astype(np.int64)
    lags = []
    for m in np.unique(level):
        own = np.flatnonzero(level == m)
        if m >= len(r.names):
            continue
        pair = np.repeat(own, p[own])
        at = _slices(e1[own] - (1 << int(m)) - p[own] + 1, p[own])
        hit = (r.names[m][at] >= 0) & (r.names[m][at] == r.names[m][s2[pair]])
        pair, lag = pair[hit], s2[pair[hit]] - at[hit]
        most = np.minimum(np.minimum(e2 - s2, e1 - s1), (e2 - s1) // 2)[pair]
        many = np.maximum(0, (most - lag) // p[pair] + 1)
        of = np.repeat(np.arange(len(pair)), many)
        lag = lag[of] + _slices(np.zeros(len(many), dtype=np.int64), many) * p[pair][of]
        pair = pair[of]
        at = np.maximum(s2[pair], s1[pair] + lag)
        lags.append(np.stack([at, np.minimum(e2[pair], e1[pair] + lag), lag], axis=1))
    return np.concatenate(lags) if lags else np.zeros((0, 3), dtype=np.int64)


def find_runs(number: np.ndarray, document: np.ndarray) -> np.ndarray:
    """(start, end, period) of every run of at least 12 words and two periods, by start, then period.

    number: words as numbers, of several documents in turn; document: which one each word is of. A run of period
    q is a diagonal of lag q: its words equal those q before. For q below 16 every earlier occurrence of each gram of four words
    counts. For q in [2g, 4g), g = 8, 16, ..., occurrences of grams of g words do: a run of two periods has a gram that doesn't
    lie within g/2 words of itself, so seven earlier ones at most are in reach, or else it consists of two touching
    runs of a period of g/2 or less, which give theirs by arithmetic. So frequent words and long repetitions of one word
    cost no more than others. Diagonals are extended to their ends by the names of longer grams. Of diagonals
    of one extent that of the smallest lag is the run: the others' lags are its multiples.
    """
    r = Repeats(number, document)
    none = np.zeros((0, 3), dtype=np.int64)
    if len(r.names) <= 2:
        return none
    found, gram, level = [], _BASE, 2
    while level < len(r.names):
        before = _earlier(r.names[level])
        entries = _entries(before, 1, 4 * gram, 0, 4 * gram) if gram == _BASE else _entries(before, 2 * gram, 4 * gram, gram // 2 + 1, 7)
        start, end, lag = _diagonals(*entries, gram)
        start, end = r.extend(start, end, lag)
        long = end - start >= lag
        found.append(np.stack([start[long] - lag[long], end[long], lag[long]], axis=1))
        gram, level = gram * 2, level + 1
    runs = _smallest(np.concatenate(found))
    more = _touching(r, runs)
    if len(more):
        start, end = r.extend(more[:, 0], more[:, 1], more[:, 2])
        long = end - start >= more[:, 2]
        runs = _smallest(np.concatenate([runs, np.stack([start - more[:, 2], end, more[:, 2]], axis=1)[long]]))
    runs = runs[runs[:, 1] - runs[:, 0] >= _SHORTEST]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of runs of equal extent that of the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row: runs of words of a text, and the text without what they repeat.

    Words are runs of non-space, case kept. A run is a stretch of at least 12 words and two periods whose words equal those one
    (smallest) period before, and that no neighbouring word extends; runs: array of (start, length, period), word numbers from 0, by start, then
    period. collapsed has the words that no run contains after its first period, joined by one blank.

    A task works on about a megabyte of texts at a time, or one longer text, with four bytes a word and level of gram lengths, as many levels as the
    longest repeated stretch has binary digits. Nothing is shuffled.

    Cases: a null, empty or wordless text has no words, no runs and an empty collapsed text; a null id or one that repeats is a
    row like others; no rows: none. Columns besides id_col and text_col are not read.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for w in words(batch.column(1), NON_SPACE, case=AS_IS):
            rows, n = w.last - w.first, len(w.hash)
            document = np.repeat(np.arange(rows), np.diff(w.first_word))
            runs = find_runs(_word_numbers(w), document) if n else np.zeros((0, 3), dtype=np.int64)
            of = document[runs[:, 0]] if n else runs[:, 0]
            depth = np.zeros(n + 1, dtype=np.int64)
            np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
            np.add.at(depth, runs[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
            # A word and the blank after it, none after a text's last.
            size = w.end[kept] - w.start[kept]
            body = np.full(int(size.sum()) + len(kept), 32, dtype=np.uint8)
            body[_slices(np.cumsum(size + 1) - size - 1, size)] = w.lowered[_slices(w.start[kept], size)]
            last = np.append(document[kept][1:] != document[kept][:-1], True) if len(kept) else np.zeros(0, dtype=bool)
            body = np.delete(body, (np.cumsum(size + 1) - 1)[last])
            room = np.zeros(rows, dtype=np.int64)
            np.add.at(room, document[kept], size + ~last)
            at = np.concatenate([[0], np.cumsum(room)])
            text = pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(body.tobytes())]).cast(pa.string())
            fields = pa.StructArray.from_arrays([pa.array(x) for x in (runs[:, 0] - w.first_word[of], runs[:, 1] - runs[:, 0], runs[:, 2])], fields=list(run))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(rows + 1)).astype(np.int32)), fields)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, rows), pa.array(np.diff(w.first_word)), lists, text], names=["doc_id", "n_words", "runs", "collapsed"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(plain, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string", one)


def planted(doc_id: Column, text: Column) -> Column:
    """text with the repetition of the query's definition: every tenth id by CRC has words repeated from some place on."""
    ws = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")

    def repeated(x: Column) -> Column:
        n, h = F.size(x["ws"]), x["h"]
        g = F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (F.lit(3) + g % 8))
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(x["ws"], place(i).cast("int"))), " ")

    h = F.crc32(doc_id.cast("string").cast("binary"))
    own = F.element_at(F.transform(F.array(F.struct(ws.alias("ws"), h.alias("h"))), lambda x: F.when(F.size(x["ws"]) > 0, repeated(x))), 1)
    return F.when(h % 10 == 0, F.coalesce(own, F.lit(""))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; every tenth, by the CRC of its id, with a repetition made of its own words."""
    docs = read(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select(
        "doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
        F.expr("1000 * b.length div -b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


OP12_SQL = rf"""
with t as (select [{", ".join(f"{x}::ubigint" for x in crc_table())}] as tab),
w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws, hex(encode(cast(doc_id as varchar))) as hx from documents),
h as (select doc_id, ws, len(ws) as n,
    cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hx, '..'), lambda x: cast('0x' || x as ubigint))),
      lambda c, x: xor(c >> 8, tab[cast(xor(c, x) & 255 as int) + 1])), 4294967295::ubigint) as bigint) as h from w, t),
a as (select *, (h // 10) % n as a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) as p from h where h % 10 = 0 and n > 0),
x as (select doc_id, n, list_transform(generate_series(0, n - 1), lambda i: ws[1 + case when i >= a then a + (i - a) % p else i end]) as ws from a
  union all select doc_id, n, ws from h where h % 10 != 0 or n = 0),
g as (select doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') as gram from (select doc_id, ws, unnest(generate_series(0, n - 6)) as i from x where n >= 12)),
d as (select b.doc_id, b.i, b.i - a.i as q from g a join g b on a.doc_id = b.doc_id and a.gram = b.gram and a.i < b.i),
e as (select *, i - row_number() over (partition by doc_id, q order by i) as island from d),
m as (select doc_id, q, min(i) - q as s, max(i) + 6 as e from e group by doc_id, q, island having count(*) + 5 >= q and count(*) + 5 + q >= 12),
r as (select doc_id, s, e, min(q) as q from m group by doc_id, s, e),
f as (select doc_id, count(*) as n_runs, first({{'s': s, 'l': e - s, 'q': q}} order by e - s desc, s, q) as b, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' order by s, q) as lines from r group by doc_id),
k as (select doc_id, string_agg(word, ' ' order by i) as kept from (select doc_id, unnest(ws) as word, unnest(generate_series(0, n - 1)) as i from x where n > 0) v
  where not exists (select 1 from r where r.doc_id = v.doc_id and v.i >= r.s + r.q and v.i < r.e) group by doc_id)
select x.doc_id, coalesce(n_runs, 0) as n_runs, b.s as start, b.l as length, b.q as period, 1000 * b.l // b.q as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from x left join f on f.doc_id = x.doc_id left join k on k.doc_id = x.doc_id
"""
