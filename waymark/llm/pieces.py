"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import read
from waymark.llm.textbytes import U64, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

_SPACE = "▁"
_SEGMENT = re.compile(" +[^ ]*|[^ ]+")
#: The lattice of a longer segment is held in windows of so many characters.
_WINDOW = 1 << 14
_AT_ONCE = 1 << 20
_STEP = 0x9E3779B97F4A7C15


class Table:
    """Open addressing over a fixed array of 64-bit hashes; find() gives their places, or -1."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.shift = 64 - max(4, (8 * len(hashes)).bit_length())
        self.slots = np.full(1 << (64 - self.shift), -1, dtype=np.int32)
        left = np.arange(len(hashes))
        slot = (hashes >> U64(self.shift)).astype(np.int64)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) % len(self.slots)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        slot = (wanted >> U64(self.shift)).astype(np.int64)
        at = self.slots[slot]
        odd = np.flatnonzero((at >= 0) & (self.hashes[at] != wanted))
        while len(odd):
            slot[odd] = (slot[odd] + 1) % len(self.slots)
            at[odd] = self.slots[slot[odd]]
            odd = odd[(at[odd] >= 0) & (self.hashes[at[odd]] != wanted[odd])]
        return at


@dataclass
class Vocabulary:
    """weight of each ordinary piece, with blanks as blanks; ids of byte pieces; what each id decodes to.

    starts[k] has, for the first k + 1 characters of any piece, a hash table of their hashes, and the piece
    that ends there (-1 if none) with its weight.
    """

    weight: dict[str, tuple[int, float]]
    starts: list[tuple[Table, np.ndarray, np.ndarray]]
    byte: list[int]
    byte_weight: float
    decoded: list[bytes]


_FACTOR = 0xD1342543DE82EF95


def _starts(weight: dict[str, tuple[int, float]]) -> list[tuple[Table, np.ndarray, np.ndarray]]:
    out = []
    for k in range(1, max(map(len, weight), default=0) + 1):
        heads = sorted({t[:k] for t in weight if len(t) >= k})
        hashes = np.zeros(len(heads), dtype=np.uint64)
        for at in range(k):
            hashes = hashes * U64(_FACTOR) + np.array([ord(t[at]) + 1 for t in heads], dtype=np.uint64)
        own = [weight.get(t, (-1, 0.0)) for t in heads]
        out.append((Table(mix(hashes)), np.array([x[0] for x in own], dtype=np.int32), np.array([x[1] for x in own])))
    return out


def load_vocabulary(model: bytes, power: float = 1.0) -> Vocabulary:
    """From a model file with byte fallback.

    A merge model ranks its pieces and has no probabilities; by Zipf's law a piece of rank r gets the
    weight (r + 10) ** -power. Pieces of a unigram model, whose scores are log probabilities, get
    exp(score * power). Control and unknown pieces take no part, and byte pieces only as bytes.
    """
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = own.get_piece_size()
    byte, weight, decoded = [-1] * 256, {}, []
    plain = [i for i in range(n) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i) or own.is_unused(i))]
    ranked = min(own.get_score(i) for i in plain) < -100
    for i in range(n):
        piece = own.id_to_piece(i)
        if own.is_byte(i):
            byte[int(piece[3:-1], 16)] = i
            decoded.append(bytes([int(piece[3:-1], 16)]))
        else:
            decoded.append(piece.replace(_SPACE, " ").encode())
    for i in plain:
        text = own.id_to_piece(i).replace(_SPACE, " ")
        if " " in text.lstrip(" "):
            raise ValueError("a piece spans words")
        score = own.get_score(i)
        weight[text] = (i, float((10.0 - score) ** -power if ranked else np.exp(score * power)))
    if min(byte) < 0:
        raise ValueError("the model has no byte fallback")
    least = min(w for _, w in weight.values())
    return Vocabulary(weight, _starts(weight), byte, least, decoded)


class Lattices:
    """Lattices of segments (blanks, then a word), filtered forwards, as flat arrays to sample from.

    A segment has a node for each of its starts, the empty one too; a node's edges are the pieces that end
    there, longer ones first, with cumulated chances in units of 2**-32 and the node they come from. Node k's
    edges start at first[k]; a draw of 32 bits takes the first edge whose chance isn't below it. Nodes
    are numbered by depth, then segment, so filtering and sampling share one order without a sort. Sums
    run within a node in a fixed order, so a segment's chances don't depend on its neighbours.
    """

    def __init__(self, vocabulary: Vocabulary, best: bool = False):
        self.v, self.best = vocabulary, best
        self.ids = np.arange(len(vocabulary.decoded), dtype=np.int32)
        self.spelled: dict[int, tuple[int, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.batches: list[tuple[int, int, np.ndarray]] = []  # first segment, first node, level
        self.last = np.zeros(0, np.int64)  # the end node of each segment
        self.nodes = 0
        self.first = np.zeros(0, np.int64)
        self.upto, self.steps, self.back, self.at, self.n = (np.zeros(0, t) for t in (np.uint32, np.int32, np.int32, np.int32, np.int32))

    def _spell(self, character: int) -> tuple[int, int]:
        """Where ids has the byte pieces of a character, and how many."""
        if character not in self.spelled:
            raw = [self.v.byte[b] for b in chr(character).encode()]
            self.spelled[character] = len(self.ids), len(raw)
            self.ids = np.append(self.ids, np.array(raw, dtype=np.int32))
        return self.spelled[character]

    def _matches(self, text: np.ndarray, room: np.ndarray) -> list[tuple]:
        """Pieces from every place of characters with so much room behind each, by length: length, places, ids' places, numbers, weights."""
        # By ever longer starts of pieces.
        place, hashed = np.arange(len(text)), np.zeros(len(text), dtype=np.uint64)
        single = np.zeros(len(text), dtype=bool)
        found = []
        for k, (table, piece, weight) in enumerate(self.v.starts):
            keep = room[place] > k
            place = place[keep]
            hashed = hashed[keep] * U64(_FACTOR) + text[place + k] + U64(1)
            at = table.find(mix(hashed))
            hit = at >= 0
            place, hashed, at = place[hit], hashed[hit], at[hit]
            own = piece[at]
            whole = np.flatnonzero(own >= 0)
            found.append((k + 1, place[whole], own[whole], 1, weight[at[whole]]))
            if not k:
                single[place[whole]] = True
        rest = np.flatnonzero(~single)
        if len(rest):
            kinds, back = np.unique(text[rest], return_inverse=True)
            spelled = np.array([self._spell(int(c)) for c in kinds], dtype=np.int32)[back]
            found.append((1, rest, spelled[:, 0], spelled[:, 1], self.v.byte_weight ** spelled[:, 1].astype(float)))
        return found

    def forward(self, text: str, every: int) -> dict[int, tuple[float, ...]]:
        """For each multiple of `every` within a long text the sums (up to a factor) at as many places before it as the longest piece has characters.

        Sums are carried on from place to place, in chunks; no more than a chunk's pieces are held."""
        reach, chunk = len(self.v.starts), 1 << 17
        before, out = [1.0], {}
        for a in range(0, len(text), chunk):
            low, b = max(0, a - reach), min(len(text), a + chunk)
            own = np.frombuffer(text[low:b].encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            found = self._matches(own, np.arange(len(own), 0, -1))
            end = np.concatenate([place + k for k, place, *_ in found]) + low
            size = np.concatenate([np.full(len(place), k) for k, place, *_ in found])
            weight = np.concatenate([w for *_, w in found])
            order = np.lexsort((-size, end))
            order = order[end[order] > a]
            first = np.searchsorted(end[order], np.arange(a + 1, b + 2)).tolist()
            size, weight = size[order].tolist(), weight[order].tolist()
            sums = before
            for i in range(b - a):
                n, total = len(sums), 0.0
                for e in range(first[i], first[i + 1]):
                    part = sums[n - size[e]] * weight[e]
                    if not self.best:
                        total += part
                    elif part > total:
                        total = part
                sums.append(total)
                if total < 1e-150:
                    sums[-reach:] = [x / total for x in sums[-reach:]]
                if (a + i + 1) % every == 0:
                    out[a + i + 1] = tuple(sums[-reach - 1 : -1])
            before = sums[-reach - 1 :]
        return out

    def add(self, segments: list[str | tuple[str, tuple[float, ...]]]) -> None:
        """Put distinct new segments in. One that goes on in the middle of a text comes with the sums at its first places."""
        segments = sorted(segments, key=lambda s: len(s if isinstance(s, str) else s[0]), reverse=True)
        bare = [s if isinstance(s, str) else s[0] for s in segments]
        lengths = np.fromiter(map(len, bare), np.int64, len(segments))
        text = np.frombuffer("".join(bare).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        of = np.repeat(np.arange(len(segments)), lengths)
        inner = np.arange(len(text)) - (np.cumsum(lengths) - lengths)[of]
        # Nodes of depth k: level[k] + segment, for the segments of at least k characters.
        level = np.concatenate([[0], np.cumsum(len(segments) - np.searchsorted(lengths[::-1], np.arange(lengths[0] + 1)))])
        found = self._matches(text, lengths[of] - inner)
        going = np.array([k for k, s in enumerate(segments) if not isinstance(s, str)], dtype=np.int64)
        given = np.array([s[1] for s in segments if not isinstance(s, str)]).reshape(len(going), len(self.v.starts) if len(going) else 0)
        ends = [level[inner[place] + k] + of[place] for k, place, *_ in found]
        counts = np.zeros(level[-1], np.int64)
        for node in ends:
            counts[node] += 1
        first = np.concatenate([[0], np.cumsum(counts)])
        fill, total_edges = first[:-1].copy(), int(first[-1])
        step, back, at, count = (np.empty(total_edges, np.int32) for _ in range(4))
        weight = np.empty(total_edges)
        for (k, place, own, n, w), node in sorted(zip(found, ends), key=lambda x: -x[0][0]):
            to = fill[node]
            fill[node] += 1
            step[to], back[to], at[to], count[to], weight[to] = k, level[inner[place]] + of[place], own, n, w
        alpha = np.zeros(level[-1])
        alpha[: level[1]] = 1.0
        if len(going):
            alpha[going] = given[:, 0]
        each, total = np.empty(total_edges), np.empty(total_edges)
        for depth in range(1, len(level) - 1):
            nodes = slice(level[depth], level[depth + 1])
            a, b = first[nodes.start], first[nodes.stop]
            each[a:b] = alpha[back[a:b]] * weight[a:b]
            sums = (np.maximum if self.best else np.add).reduceat(each[a:b], first[nodes] - a)
            alpha[nodes] = sums
            total[a:b] = np.repeat(sums, counts[nodes])
            if depth < given.shape[1]:
                alpha[level[depth] + going] = given[:, depth]
                continue
            low = np.flatnonzero(sums < 1e-150)
            if len(low):
                # Only ratios matter: lift those that a later piece can still start from.
                lift = 1.0 / sums[low]
                for up in range(max(0, depth - len(self.v.starts)), depth + 1):
                    alpha[level[up] + low] *= lift
        begin = len(self.steps)
        heads = first[:-1][counts > 0]
        if self.best:
            top = np.flatnonzero(each == total)
            owner = np.repeat(np.arange(level[-1]), counts)[top]
            new = np.append(True, owner[1:] != owner[:-1])
            top, owner = top[new], owner[new]
            first = np.zeros(level[-1], np.int64)
            first[owner] = np.arange(len(top))
            step, back, at, count = step[top], back[top], at[top], count[top]
            run = np.full(len(top), 0xFFFFFFFF, dtype=np.int64)
        else:
            share = np.floor(each / total * 4294967296.0).astype(np.int64)
            run = np.cumsum(share)
            run -= np.repeat(run[heads] - share[heads], counts[counts > 0])
            run = np.minimum(run, 0xFFFFFFFF)
            run[first[1:][counts > 0] - 1] = 0xFFFFFFFF
        self.first = np.concatenate([self.first, begin + first[: level[-1]]])
        self.upto, self.steps, self.back, self.at, self.n = (np.concatenate([old, part.astype(old.dtype)]) for old, part in ((self.upto, run), (self.steps, step), (self.back, back + self.nodes), (self.at, at), (self.n, count)))
        self.batches.append((len(self.known), self.nodes, level))
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))
        self.last = np.concatenate([self.last, self.nodes + level[lengths] + np.arange(len(segments))])
        self.nodes += int(level[-1])


    def at_depth(self, segment: str | tuple, depths: np.ndarray) -> np.ndarray:
        """The nodes of a segment after so many characters."""
        own = self.known[segment]
        first, node, level = next(x for x in reversed(self.batches) if x[0] <= own)
        return node + level[depths] + own - first

    def walk(self, node: np.ndarray, where: np.ndarray, left: np.ndarray, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces sampled backwards by one walker for each node until it has passed `left` characters: walker, end and edge of each.

        place: where the node lies in its text; the draw there hangs on the seed and the place alone.
        """
        who, found = np.arange(len(node)), []
        while len(node):
            draw = (mix(seed + place.astype(np.uint64) * U64(_STEP)) >> U64(32)).astype(np.uint32)
            edge = self.first[node]
            on = np.flatnonzero(self.upto[edge] < draw)
            while len(on):
                edge[on] += 1
                on = on[self.upto[edge[on]] < draw[on]]
            step = self.steps[edge]
            found.append((who, where, edge))
            left = left - step
            go = left > 0
            node, where, place, left, seed, who = self.back[edge][go], (where - step)[go], (place - step)[go], left[go], seed[go], who[go]
        return tuple(np.concatenate(x) for x in zip(*found))


def _long(segment: str, seed: np.uint64, lattices: Lattices, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ends, ids' places, ids' numbers) of the pieces of a long segment, stretch by stretch from its end.

    Forward sums are carried through the whole segment once; a window's lattice starts from those before it, so it has the chances of the whole
    segment's. Windows are sampled side by side from each of their last places, one of which the path from behind comes out at.
    """
    reach = len(lattices.v.starts)
    starts = list(range(0, len(segment), window))
    sums = lattices.forward(segment, window)
    at, step = len(segment), max(1, _AT_ONCE // window)
    for a in range((len(starts) - 1) // step * step, -1, -step):
        group = starts[a : a + step]
        stops = [min(s + window, len(segment)) for s in group]
        lows = [max(0, s - reach) for s in group]
        own = [segment[low:stop] if not low else (segment[low:stop], sums[s]) for s, low, stop in zip(group, lows, stops)]
        if lattices.nodes > 2 * _AT_ONCE:
            lattices.clear()
        fresh = set(own) - lattices.known.keys()
        if fresh:
            lattices.add(list(fresh))
        ends = [np.arange(max(s, stop - reach) + 1, stop + 1) for s, stop in zip(group, stops)]
        node = np.concatenate([lattices.at_depth(x, e - low) for x, e, low in zip(own, ends, lows)])
        entry = np.concatenate(ends)
        left = entry - np.repeat(group, [len(e) for e in ends])
        who, where, edge = lattices.walk(node, entry, left, entry, np.full(len(entry), seed))
        # Each walker's steps are in order already.
        order = np.argsort(who.astype(np.uint16 if len(entry) < 1 << 16 else np.int64), kind="stable")
        cut = np.searchsorted(who[order], np.arange(len(entry) + 1))
        first = np.cumsum([0] + [len(e) for e in ends])
        for k in range(len(group) - 1, -1, -1):
            if at <= group[k]:
                continue
            walker = int(first[k] + at - ends[k][0])
            mine = order[cut[walker] : cut[walker + 1]]
            yield where[mine], lattices.at[edge[mine]], lattices.n[edge[mine]]
            at = int(where[mine[-1]] - lattices.steps[edge[mine[-1]]])


def encode(texts: list[str], keys: np.ndarray, lattices: Lattices, limit: int = 40_000, window: int = _WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in turn, and the texts' offsets. keys: 64 bits for each text, which seed its draws.

    The draw at an end of a piece hangs on the key and the character's place alone, so a text and its
    key give the same pieces in any batch. A blank is put before every text, as the model's own
    encoder does. A segment longer than `window` is filtered in one go and sampled in windows, with the result of the whole segment's lattice.
    """
    split = [_SEGMENT.findall(f" {text}") for text in texts]
    every = [s for own in split for s in own]
    if not every:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    per_text = np.fromiter(map(len, split), np.int64, len(split))
    lengths = np.fromiter(map(len, every), np.int64, len(every))
    owner = np.repeat(np.arange(len(texts)), per_text)
    stop = np.cumsum(lengths)  # over all texts
    begin_of_text = np.concatenate([[0], stop[np.cumsum(per_text) - 1]])[:-1]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def make_room() -> None:
        if len(lattices.known) > limit or lattices.nodes > 2 * _AT_ONCE:
            lattices.clear()

    short = np.flatnonzero(lengths <= window)
    sizes = np.cumsum(lengths[short])
    a = 0
    while a < len(short):
        # So many characters at a time that their lattices stay small, however long a text is.
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + _AT_ONCE, side="right")))
        make_room()
        at = short[a:b]
        own = [every[k] for k in at]
        fresh = [s for s in set(own) if s not in lattices.known]
        if fresh:
            lattices.add(fresh)
        node = lattices.last[np.fromiter(map(lattices.known.__getitem__, own), np.int64, b - a)]
        of = owner[at]
        _, place, edge = lattices.walk(node, stop[at], lengths[at], stop[at] - begin_of_text[of], keys[of])
        parts.append((place, lattices.at[edge], lattices.n[edge]))
        a = b
    for k in np.flatnonzero(lengths > window):
        before, inside, key = stop[k] - lengths[k], stop[k] - lengths[k] - begin_of_text[owner[k]], keys[owner[k]]
        # Places are counted from the segment's start; the seed makes up for that.
        seed = key + U64(int(inside) * _STEP & 0xFFFFFFFFFFFFFFFF)
        parts += [(ends + before, at, n) for ends, at, n in _long(every[k], seed, lattices, max(1, window // 8))]
    place, at, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(place)
    place, at, count = place[order], at[order], count[order]
    first = np.concatenate([[0], np.cumsum(count)])
    ids = lattices.ids[np.repeat(at - first[:-1], count) + np.arange(first[-1])]
    ends = np.searchsorted(place, stop[np.cumsum(per_text) - 1], side="right")
    return ids, np.concatenate([[0], first[ends]])


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text that ids were encoded from, whatever their segmentation."""
    return b"".join([vocabulary.decoded[i] for i in ids])[1:].decode()


def tokenize(docs: DataFrame, mode: str = "sample", seed: int = 0, power: float = 1.0, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids, n_tokens, text_sha256, lossless) for every row.

    A text is cut into segments, each of blanks and the word after them, which no piece crosses. Over
    the lattice of pieces of each segment, forward filtering sums the weights of all ways to each
    character, and backward sampling draws pieces from the end, each by its share. Draws are seeded by
    the row's id, `seed` and the place in the text. mode `best` takes the heaviest way instead.
    Characters without a piece, and U+2581 itself, become byte pieces, so decoding gives back
    the text: lossless says so, by decoding each row, and text_sha256 is that of the decoded text.

    The model is read on the driver and broadcast (refused above 64 MB). A task holds the lattices of at most
    40,000 distinct segments besides those of 500 kB of text.

    Cases: a null or empty text has the one piece of the blank put before it; a null id seeds as 0; equal
    rows get equal pieces; very long texts are encoded whole, about a million characters at a time, and unbroken runs of
    more than 16,384 characters in windows of the lattice of the whole run; no rows: none. Other columns are not read.
    Draws have 32 bits, and so have chances: a piece of a chance below 2**-32 at its end may never be drawn.
    """
    if mode not in ("sample", "best"):
        raise ValueError(f"mode: {mode}")
    spark = docs.sparkSession
    if "://" in model:
        body = bytes(spark.read.format("binaryFile").load(model).select("content").first()[0])
    else:
        with open(model, "rb") as f:
            body = f.read()
    if len(body) > 64 << 20:
        raise ValueError("the model is too large to broadcast")
    shared = spark.sparkContext.broadcast(body)

    def run(batches):
        v = load_vocabulary(shared.value, power)
        lattices = Lattices(v, mode == "best")
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            salts = mix(np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64) + U64(_STEP * (seed + 1) & 0xFFFFFFFFFFFFFFFF))
            a = 0
            while a < batch.num_rows:
                texts, size = [], 0
                while a + len(texts) < batch.num_rows and (size < 500_000 or not texts):
                    texts.append(column[a + len(texts)].as_py() or "")
                    size += len(texts[-1])
                n = len(texts)
                tokens, at = encode(texts, salts[a : a + n], lattices)
                digest, same = [], []
                flat = tokens.tolist()
                for k in range(n):
                    text = decode(flat[at[k] : at[k + 1]], v)
                    digest.append(hashlib.sha256(text.encode()).hexdigest())
                    same.append(text == texts[k])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens))
                yield pa.RecordBatch.from_arrays([ids.slice(a, n), lists, pa.array(np.diff(at)), pa.array(digest), pa.array(same)], names=["doc_id", "token_ids", "n_tokens", "text_sha256", "lossless"])
                a += n

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, token_ids array<int>, n_tokens long, text_sha256 string, lossless boolean")


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sampled."""
    return tokenize(read(spark, sf_dir, "documents"))
