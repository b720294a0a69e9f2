"""Operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import binascii
import collections
import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import chat, decontaminate, licenses, mtree, neardup, pieces, quality, sharding, superminhash, textbytes, urlfilter, warc

LOWER = {i: i + 32 for i in range(65, 91)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["the", "Of", "and", "Straße", "naïve", "x1", "a-b", "漢字", "EN", "q", "zeta", "eta", "theta", "iota", "kappa"]
    out = [None, "", "   \n", "one", "two words", "𝔘 x"]
    out += [" ".join(r.choices(vocabulary, k=r.randint(3, 60))) for _ in range(n)]
    out += [out[10], out[10] + " more", " ".join(r.choices(vocabulary, k=30_000))]
    return out


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# Words and shingles


@pytest.mark.parametrize("kind, pattern", [(textbytes.NON_SPACE, NONSPACE), (textbytes.ALNUM, ALNUM)])
@pytest.mark.parametrize("chunk", [1, 100, 1 << 20])
def test_words(kind, pattern, chunk):
    own = texts()
    got = []
    for w in textbytes.words(pa.array(own, pa.string()), kind, chunk):
        got += [[x.decode() for x in w.text(w.first_word[r], w.first_word[r + 1])] for r in range(w.last - w.first)]
    assert got == [pattern.findall((t or "").translate(LOWER)) for t in own]


def test_equal_words_have_equal_hashes():
    of = collections.defaultdict(set)
    for w in textbytes.words(pa.array(texts(), pa.string()), textbytes.NON_SPACE, 50):
        for r in range(len(w.hash)):
            of[w.text(r, r + 1)[0]].add(int(w.hash[r]))
    assert all(len(x) == 1 for x in of.values()) and len({min(x) for x in of.values()}) == len(of)


def shingle_set(text, size):
    ws = NONSPACE.findall((text or "").translate(LOWER))
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def test_shingles():
    own = texts()
    counts = []
    for w in textbytes.words(pa.array(own, pa.string()), textbytes.NON_SPACE, 300):
        counts += np.diff(textbytes.shingles(w, 4)[1]).tolist()
    assert counts == [len(shingle_set(t, 4)) for t in own]


# 10: near-duplicates


def test_superminhash_by_the_sequential_algorithm():
    m = 32
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (0, 1, 3, 40, 900)]
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = superminhash.signatures(np.concatenate(sets), off, m)
    for i, own in enumerate(sets):
        want = [(1 << 64) - 1] * m
        for x in own:
            p = list(range(m))
            for j in range(m):
                rank, s = superminhash._draw(np.array([x]), j, m)
                p[j], p[int(s[0])] = p[int(s[0])], p[j]
                want[p[j]] = min(want[p[j]], int(rank[0]))
        assert got[i].tolist() == want


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(6)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (600, 200, 200))
    s = superminhash.signatures(np.concatenate([common, a, common, b]), np.array([0, 800, 1600]), 256)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.12


def brute_groups(rows, size, percent):
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, size):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = list(enumerate(texts(2, 10)))
    for _ in range(25):
        base = r.choices(words, k=120)
        for _ in range(r.randint(1, 12)):
            own = list(base)
            for _ in range(r.randint(0, 8)):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, rows[40][1]) for k in range(20)]
    r.shuffle(rows)
    got = neardup.near_duplicates(frame(spark, [(i, t, 0, 1) for i, t in rows], "doc_id long, text string, node long, band long"), size=size)
    assert {tuple(x) for x in got.collect()} == brute_groups(rows, size, 80)


def test_near_duplicates_edge_cases(spark):
    df = frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "A B C D E F"), (7, None), (8, "")], "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(df, size=4).collect()), key=str)
    assert got == sorted([(None, 3, None, True), (3, 3, 1, False), (3, 3, 1, False), (1, 3, 1, True), (7, 0, 7, True), (8, 0, 8, True)], key=str)
    left = neardup.deduplicate(frame(spark, [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "q r s t u v", "y"), (None, None, "z")], "doc_id long, text string, kept string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(1, "a b c d e f", "x"), (2, "q r s t u v", "y"), (None, None, "z")], key=str)
    assert neardup.near_duplicates(frame(spark, [], "doc_id long, text string")).count() == 0


def test_near_duplicates_of_an_id_with_several_texts(spark):
    r = random.Random(9)
    a, b, c = (" ".join(r.choices([f"w{i}" for i in range(400)], k=100)) for _ in range(3))
    rows = [(1, a), (1, b), (1, c), (2, a + " x"), (3, b + " x"), (4, c + " x"), (5, "one two three four five")]
    got = {(x.doc_id, x.component_id) for x in neardup.near_duplicates(frame(spark, rows, "doc_id long, text string"), size=4).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)}


@pytest.mark.parametrize("exact", [False, True])
def test_near_duplicates_at_the_threshold(spark, exact):
    # Ten of thirteen words' five-word shingles: 8 of 10 are shared by two texts that end apart, just the threshold; 7 of 11 if two words differ.
    rows = []
    for k in range(3500):
        base = [f"t{k}x{j}" for j in range(12)]
        rows += [(3 * k, " ".join([*base, "a"])), (3 * k + 1, " ".join([*base, "b"])), (3 * k + 2, " ".join([*base[:11], "c", "d"]))]
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(frame(spark, rows, "doc_id long, text string"), exact=exact).collect()}
    assert got == {i: 3 * (i // 3) if i % 3 < 2 else i for i, _ in rows}


def test_deduplicate_with_columns_of_any_name_and_type(spark):
    df = frame(spark, [(1, "a b c d e f", {"k": 1}), (1, "a b c d e f", {"k": 2}), (2, "A b c d e f", {"k": 3}), (None, None, None)], "`doc.id` long, `the text` string, `a.b` map<string,int>")
    left = neardup.deduplicate(df, id_col="doc.id", text_col="the text")
    assert left.columns == df.columns and sorted(map(str, left.collect())) == sorted(map(str, [x for x in df.collect() if x[0] is None or x[2] == {"k": 1}]))


# 3: decontamination


def brute_hits(docs, items, window):
    out = []
    for i, t in docs:
        ws = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for j, u in items:
            us = ALNUM.findall((u or "").translate(LOWER))
            n = min(window, len(us))
            grams = {tuple(us[k : k + n]) for k in range(len(us) - n + 1)} if n else set()
            for k in range(len(ws) - n + 1 if n else 0):
                if tuple(ws[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(j))
        out.append((i, len(ws), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_contamination(spark, block):
    r = random.Random(9)
    own = texts(4, 30)
    items = [(1, " ".join((own[10] or "").split()[:12])), (2, "THE of"), (2, "the OF"), (3, None), (4, "!!"), (10, "zeta"), (11, own[-1][:2000])]
    docs = [(k, t) for k, t in enumerate(own)] + [(0, own[12]), (None, own[13])]
    r.shuffle(docs)
    df = frame(spark, [(i, t, 1) for i, t in docs], "doc_id long, text string, spans int")
    bench = frame(spark, items, "item_id long, text string")
    got = decontaminate.contamination(df, bench, block_bytes=block).withColumn("n", decontaminate.n_hit("spans"))
    assert sorted([(x.doc_id, x.n_words, x.n, tuple(x["items"])) for x in got.collect()], key=str) == brute_hits(docs, items, 10)
    kept = decontaminate.clean(df, bench, block_bytes=block)
    assert sorted((str(x.doc_id) for x in kept.collect())) == sorted(str(i) for i, _, n, _ in brute_hits(docs, items, 10) if not n)
    assert kept.columns == df.columns


def test_contamination_of_empty_tables(spark):
    docs, none = frame(spark, [(1, "a b")], "doc_id long, text string"), frame(spark, [], "item_id long, text string")
    assert [tuple(x) for x in decontaminate.contamination(docs, none).collect()] == [(1, 2, [], [])]
    assert decontaminate.clean(docs, none).count() == 1
    assert decontaminate.contamination(docs.where("false"), docs.toDF("item_id", "text")).count() == 0


# 9: sharding


def test_shards_match_the_mixture(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 5 else None, f"t{i}", 5) for i in range(3000)] + [(7, "s0", "t7", 5)] * 3
    out = sharding.stratified_shards(frame(spark, rows, "doc_id long, source string, text string, shard int"), 24, rows_per_bucket=100).collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for x in out:
        by[x.shard].append(x)
    sizes = {len(v) for v in by.values()}
    assert len(by) == 24 and max(sizes) - min(sizes) <= 1
    total = collections.Counter(r[1] for r in rows)
    for v in by.values():
        assert sorted(x.slot for x in v) == list(range(len(v)))
        own = collections.Counter(x.source for x in v)
        assert all(abs(own[s] - n / 24) <= 2 for s, n in total.items())
    again = sharding.stratified_shards(frame(spark, rows, "doc_id long, source string, text string, shard int", 5), 24, rows_per_bucket=100)
    assert {(x.doc_id, x.text): x.shard for x in again.collect() if x.doc_id != 7} == {(x.doc_id, x.text): x.shard for x in out if x.doc_id != 7}


def test_shards_of_few_rows(spark):
    df = frame(spark, [(None, None, None), (1, "a", "x")], "doc_id long, source string, text string")
    assert len(sharding.stratified_shards(df, 24).collect()) == 2
    assert sharding.stratified_shards(df.where("false"), 24).collect() == []


# 8: WARC


@pytest.mark.parametrize("most", [1 << 16, 1, 0])
def test_warc_round_trip(spark, tmp_path, most):
    body = "<p>" + "é" * 60 + "</p>"
    nasty = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"
    rows = [(5, "http://a/x", body), (3, "http://a/y?q", body), (9, "http://b/\r\nX: 1", body), (1, None, None), (2, "", ""), (4, "http://c", nasty * 3), (6, "http://c", nasty * 3), (7, "http://d", "short"), (8, "http://d", "short"), (None, "http://e", body), (3, "http://a/y?q", body), (11, "http://l", "x\r" * 70_000), (12, "http://m", "\r\n" * 80)]
    warc.write_warc(frame(spark, [(*r, "q") for r in rows], "page_id long, url string, html string, digest string"), f"file://{tmp_path}/w", most=most)
    records = warc.read_warc(spark, f"file://{tmp_path}/w")
    assert records.count() == 3 * len(rows)
    found = [x for x in warc.captures(records).collect()]
    assert len(found) == len(rows) and all(len(x.requests) == len(x.metadata) == 1 for x in found)
    page = {x.capture: (re.search(r"page-id: (-?\d+)", x.metadata[0].block) or [None, None])[1] for x in found}
    got = collections.Counter((page[x.capture], x.response.type, x.response.payload, page.get(x.response.refers_to)) for x in found)
    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= 100:
            first[t] = min(i, first.get(t, i))
    want = collections.Counter()
    for i, _, t in rows:
        again = t in first and i != first[t]
        want[(None if i is None else str(i), "revisit" if again else "response", None if again else t or "", str(first[t]) if again else None)] += 1
    assert got == want
    assert all(x.response.payload_digest == "sha256:" + hashlib.sha256(x.response.payload.encode()).hexdigest() and x.response.http_length == len(x.response.payload.encode()) for x in found if x.response.type == "response")


def test_warc_of_no_pages(spark, tmp_path):
    warc.write_warc(frame(spark, [], "page_id long, url string, html string"), f"file://{tmp_path}/w")
    assert warc.captures(warc.read_warc(spark, f"file://{tmp_path}/w")).count() == 0


# 2: chat


@pytest.mark.parametrize("text", ["", "<", "<|", "<\\|", "<\\\\|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "%0A\n%25"])
def test_escapes(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def brute_chat(rows):
    out = {}
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, own in by.items():
        own.sort()
        all_, loss = "".join(f"{r}\n{t}\n" for _, _, r, t in own), "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(all_.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget, history", [(40, 10), (1024, 256)])
def test_chat_windows(spark, budget, history):
    r = random.Random(4)
    pool = [t for t in texts(5, 20) if t is None or len(t) < 2000] + ["<|im_end|><|im_start|>assistant ok"]
    rows = [(c, k, "system" if k == 0 and c % 2 else ("user", "assistant")[k % 2], r.choice(pool)) for c in range(20) for k in range(r.randint(1, 30))]
    rows += [(None, 0, None, None), (50, None, "assistant", "x"), (50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (51, 0, "user\n<|", "long " * 3000)]
    df = frame(spark, [(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, window int")
    windows = chat.format_chat(df, budget, history)
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.digests(windows).collect()}
    assert got == brute_chat(rows)
    for w in windows.collect():
        turns = chat.parse(w.text)
        assert w.tokens <= budget or len(turns) - w.repeated == 1
        if w.conv_id is not None and w.conv_id < 20 and w.conv_id % 2:
            assert turns[0][0] == "system"


def test_chat_of_very_long_runs(spark):
    runs = [c * 5_000_000 for c in (" ", "\n", "\u2003", "x", "7", "!")]
    rows = [(k, 0, "assistant", f"a{t}b\n {t}") for k, t in enumerate(runs)]
    windows = chat.format_chat(frame(spark, rows, "conv_id long, turn long, role string, text string", 6))
    assert {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.digests(windows, grouped=True).collect()} == brute_chat(rows)


def test_tokens_of_long_runs_are_the_same():
    with open(chat.TOKENIZER, "rb") as f:
        own = chat.encoding(f.read())
    for run in (" " * 3000, "\n" * 2500, " \n\t\u00a0" * 700, "\u2003" * 2001):
        for text in (run, f"a{run}", f"{run}b", f"a{run}b", f"{run}\x1cb", f"{run}<|", f"x {run}1{run}{run}'s"):
            assert chat.count_tokens(own, text) == len(own.encode_ordinary(text))


def test_chat_of_no_rows(spark):
    assert chat.digests(chat.format_chat(frame(spark, [], "conv_id long, turn long, role string, text string"))).count() == 0


# 1: urls


def test_rules(spark):
    rows = [(1, "http://Com/en/x"), (2, "https://a.example.com/en/7#x"), (3, "x://notcom/en/"), (4, "http://b.net?/de/"), (5, "http://example.net/de/8"), (6, "http://q.example.net/de/9"), (7, None), (8, "com/en/"), (9, "a://org/es/\nx?y"), (10, "http://x.com:80/en/")]
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urlfilter.filter_urls(frame(spark, [(*r, "z") for r in rows], "page_id long, url string, host string"), urlfilter.RULES).collect()}
    assert got == {1: ("com", "/en/x", "com/en/", "block"), 2: ("a.example.com", "/en/7", "example.com/en/7", "allow"), 3: ("notcom", "/en/", None, "allow"), 4: ("b.net", "", None, "allow"), 5: ("example.net", "/de/8", "example.net/de/8", "allow"), 6: ("q.example.net", "/de/9", "net/de/", "block"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("org", "/es/\nx", "org/es/", "block"), 10: ("x.com:80", "/en/", None, "allow")}


def test_url_models_tell_rejected_from_accepted(spark):
    r = random.Random(8)
    good = [f"https://{''.join(r.choices('aeioulnrst', k=8))}.info/fr/{r.randint(1, 9999)}" for _ in range(800)]
    bad = [f"http://{r.choice(['casino', 'spam', 'ads'])}-{''.join(r.choices('xqzkw', k=6))}.info/win?{r.randint(1, 99)}" for _ in range(200)]
    out = urlfilter.filter_urls(frame(spark, list(enumerate(good + bad)), "page_id long, url string"), []).collect()
    rejected = {x.page_id for x in out if x.verdict == "block"}
    assert len(rejected & set(range(800, 1000))) > 190 and len(rejected & set(range(800))) < 16
    assert urlfilter.filter_urls(frame(spark, [], "page_id long, url string"), []).count() == 0


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_url_scores_against_an_unhashed_model(spark, most):
    r = random.Random(5)
    urls = ["", None, "http://é.c/x", "ab"] + ["http://" + "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789-./?=&", k=r.randint(0, 40))) for _ in range(800)]
    rows = [(i, u, i % 2, i % 5 > 0) for i, u in enumerate(urls + urls[:50])]
    df = frame(spark, rows, "page_id long, url string, label int, trains boolean")
    model = urlfilter.gram_scores(urlfilter.train(df, 4), 4).persist()
    got = {x.page_id: x.lm_score for x in urlfilter.score(df, model, 4, most).collect()}

    def places(u):
        s = [0] * 4 + [int(urlfilter._CLASS[b]) for b in (u or "").encode()] + [0]
        return [(tuple(s[i - 4 : i]), s[i]) for i in range(4, len(s))]

    counts = [[collections.defaultdict(collections.Counter) for _ in range(5)] for _ in range(2)]
    for _, u, label, trains in rows:
        for context, symbol in places(u) if trains else ():
            for k in range(5):
                counts[label][k][context[4 - k :]][symbol] += 1
    assert len(counts[0][4]) > 4096 and len(got) == len(rows)
    for i, u, _, _ in rows:
        total = 0
        for context, symbol in places(u):
            p = [1 / 64, 1 / 64]
            for c, k in itertools.product((0, 1), range(5)):
                seen = counts[c][k].get(context[4 - k :])
                if seen:
                    p[c] = (seen[symbol] + len(seen) * p[c]) / (seen.total() + len(seen))
            total += np.log2(p[1]) - np.log2(p[0])
        assert abs(got[i] / 65536 - total / len(places(u))) < 1e-4


# 4: search


def brute_top(rows, width, k=20):
    pad = [(i, tuple(v) + (0,) * (width - len(v))) for i, v in rows if i is not None and v is not None]
    want = collections.Counter()
    for q, own in {x for x in pad if x[0] % 20 == 0}:
        best = sorted((-sum(a * b for a, b in zip(own, v)), c) for c, v in pad if c != q)[:k]
        want.update((q, n + 1, c, -s) for n, (s, c) in enumerate(best))
    return want


@pytest.mark.parametrize("bucket_rows, block, max_pivots", [(64, 16384, 4096), (300, 11, 4096), (4096, 16384, 4096), (50, 20, 3)])
def test_top_k(spark, bucket_rows, block, max_pivots):
    r = np.random.default_rng(7)
    base = r.normal(0, 20, (6, 8))
    m = np.round(base[r.integers(0, 6, 900)] + r.normal(0, 6, (900, 8))).astype(int).tolist()
    m[30] = m[31] = m[32]
    rows = list(enumerate(m)) + [(900, None), (None, [1] * 8), (901, []), (902, [3]), (5, m[5]), (40, m[40]), (60, m[61])] + [(903, m[5])] * 200
    df = frame(spark, [(*x, 0) for x in rows], "vec_id long, vector array<long>, score int")
    got = mtree.top_k(df, F.col("vec_id") % 20 == 0, bucket_rows=bucket_rows, page=16, block=block, max_pivots=max_pivots).collect()
    assert collections.Counter(map(tuple, got)) == brute_top(rows, 8)


def test_top_k_of_large_components(spark):
    r = random.Random(3)
    big = 1 << 30
    rows = [(0, [big, 1, 1])] + [(i, [big - (i % 3 == 0), r.randint(0, 3), r.randint(0, 3)]) for i in range(1, 60)]
    got = mtree.top_k(frame(spark, rows, "vec_id long, vector array<long>"), F.col("vec_id") % 20 == 0, page=4, bucket_rows=16)
    assert collections.Counter(map(tuple, got.collect())) == brute_top(rows, 3)
    huge = [(0, [1 << 62, 1 << 62]), (1, [1 << 62, 5]), (2, [-(1 << 62), -5]), (3, [0, 1])]
    got = mtree.top_k(frame(spark, huge, "vec_id long, vector array<long>"), F.col("vec_id") % 20 == 0)
    assert [tuple(x) for x in got.orderBy("rank").collect()] == [(0, 1, 1, (1 << 63) - 1), (0, 2, 3, 1 << 62), (0, 3, 2, -(1 << 63) + 1)]


@pytest.mark.parametrize("page", [16, 64])
def test_trees_avoid_computations_among_clusters(page):
    r = np.random.default_rng(1)
    x = np.round(r.normal(0, 60, (40, 64))[r.integers(0, 40, 4000)] + r.normal(0, 3, (4000, 64))).astype(np.int64)
    top = float(np.sqrt((x**2).sum(axis=1).max())) + 1e-9
    tree, w = mtree.MTree.undump(mtree.MTree.load(np.arange(4000), x, top, page).dump()), mtree.Wanted(np.arange(0, 4000, 20), x[::20], 20, top)
    tree.search(w)
    every = x[::20] @ x.T
    every[np.arange(200), np.arange(0, 4000, 20)] = -(10**12)
    assert (w.score == -np.sort(-every, axis=1)[:, :20]).all() and tree.computed < 0.3 * every.size


def test_top_k_of_few(spark):
    schema = "vec_id long, vector array<long>"
    assert [tuple(x) for x in mtree.top_k(frame(spark, [(0, [1]), (1, [2])], schema), F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2)]
    assert mtree.top_k(frame(spark, [], schema), F.col("vec_id") == 0).count() == 0


def test_quantized(spark):
    df = frame(spark, [(1, [0.5, -0.01]), (2, [float("nan")]), (3, [float("inf")]), (4, [None]), (5, None), (6, [])], "i int, e array<float>")
    assert {x.i: x.v for x in df.select("i", mtree.quantized(F.col("e")).alias("v")).collect()} == {1: [32, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


# 5: quality


def test_label_model_finds_accuracies():
    r = np.random.default_rng(3)
    truth = r.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.8, 0.7])
    votes = np.where((r.random((20_000, 4)) < accuracy) == truth[:, None], 2, 0)
    votes[r.random(votes.shape) < 0.3] = 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert np.abs(model.accuracies() - accuracy).max() < 0.03 and abs(model.prior - 0.7) < 0.03


def plain_votes(text):
    """The eleven labellers, word by word."""
    raw = text.encode()
    ws = [w.lower() if w.isascii() else w.translate(LOWER) for w in NONSPACE.findall(text)]
    n, size = max(1, len(ws)), max(1, len(raw))
    letters, upper, digits = (sum(map(f, raw)) for f in (lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57))
    marks, stops = (sum(b in own.encode() for b in raw) for own in ("!#$%&*+/<=>@\\^_`{|}~", ".?!"))
    known = sum(w in quality.FUNCTION_WORDS for w in ws)
    again, near = len(ws) - len(set(ws)), sum(a == b for a, b in zip(ws, ws[1:]))
    pairs = list(zip(ws, ws[1:]))
    twice, most, long = len(pairs) - len(set(pairs)), max(collections.Counter(ws).values(), default=0), sum(len(w.encode()) > 30 for w in ws)
    letters_or_one, some = max(1, letters), len(ws) >= 5
    rules = [
        (marks > 0.15 * n, marks < 0.03 * n and some),
        (upper > 0.5 * letters_or_one and some, upper < 0.25 * letters_or_one and some),
        (known < 0.03 * n and n >= 20, known > 0.10 * n and some),
        (stops == 0 and n >= 30, stops * 60 > n and stops < 0.5 * n and some),
        (again > 0.8 * n and 50 <= n < 400, again < 0.6 * n and n >= 20),
        (near > 0.1 * n and n >= 20, near < 0.03 * n and n >= 20),
        (twice > 0.5 * n and n >= 20, twice < 0.25 * n and n >= 20),
        (most > 0.25 * n and n >= 20, most < 0.15 * n and n >= 20),
        (letters < 0.6 * size, letters > 0.7 * size and some),
        (size > 13 * n and some or long > 0.1 * n and some, size < 11 * n and some),
        (digits > 0.2 * size, digits < 0.05 * size and some),
    ]
    return tuple(0 if not ws or bad else 2 if good else 1 for bad, good in rules)


def test_quality_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = docs.collect() + [(9000, None), (9001, ""), (9002, "AAAA BBBB CCCC DDDD EEEE FFFF")]
    got = {x.doc_id: x for x in quality.classify(frame(spark, [tuple(x) for x in rows], "doc_id long, text string")).collect()}
    votes = {i: plain_votes(t or "") for i, t in rows}
    counts = collections.Counter(votes.values())
    good = {v: 1 / (1 + np.exp(2.0 * v.count(0) - v.count(2))) for v in counts}
    for _ in range(100):
        p = [[[1.0 + sum(c * (good[v] if k else 1 - good[v]) for v, c in counts.items() if v[j] == s) for s in (0, 2)] for j in range(11)] for k in (0, 1)]
        prior = min(1 - 1e-3, max(1e-3, sum(c * good[v] for v, c in counts.items()) / counts.total()))
        new = {}
        for v in counts:
            q = [x * np.prod([p[k][j][v[j] // 2] / sum(p[k][j]) for j in range(11) if v[j] != 1]) for k, x in ((0, 1 - prior), (1, prior))]
            new[v] = q[1] / (q[0] + q[1])
        done = max(abs(new[v] - good[v]) for v in counts) < 1e-6
        if done:
            break
        good = new
    assert all(abs(got[i].posterior - new[votes[i]]) < 1e-4 for i in got)
    own = quality.fit(frame(spark, [tuple(x) for x in rows], "doc_id long, text string"))
    for i, t in rows:
        raw, ws = (t or "").encode(), [w.translate(LOWER) for w in NONSPACE.findall(t or "")]
        if not ws:
            assert got[i].score == 0 and not got[i].good
            continue
        cells = collections.Counter(quality._grams(np.frombuffer(raw[k : k + 3], np.uint8), own.bits)[0] for k in range(len(raw) - 2))
        pairs = list(zip(ws, ws[1:]))
        z = own.bias + sum(own.weights[c] * (m / max(1, len(raw) - 2)) ** 0.5 for c, m in cells.items())
        z += sum(own.weights[(1 << own.bits) + k] * (m / len(ws)) ** 0.5 for k, m in enumerate((sum(a == b for a, b in pairs), len(pairs) - len(set(pairs)), max(collections.Counter(ws).values()))))
        assert abs(got[i].score - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-4 and got[i].good == (got[i].score >= 0.5)


def test_quality_against_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality.classify(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("quality", "good").collect()
    good, bad = [x.good for x in got if x.quality == 1], [x.good for x in got if x.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


def test_quality_of_a_table_of_copies(spark):
    each = [t for t in texts(4, 30) if t and t.strip() and len(t) < 1000]
    copies = frame(spark, [(i, t) for i, t in enumerate(each * 40)], "doc_id long, text string")
    once = frame(spark, list(enumerate(each)), "doc_id long, text string")
    own, want = (quality.fit(df, sample=5) for df in (copies, once))
    assert own.weights.any() and ((own.weights != 0) == (want.weights != 0)).all()


def test_quality_edge_cases(spark):
    df = frame(spark, [(k, t, k) for k, t in enumerate(texts())], "doc_id long, text string, score int")
    got = {x.doc_id: x for x in quality.classify(df).collect()}
    assert len(got) == df.count() and not got[0].good and got[0].score == 0 and not got[1].good
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {i for i, x in got.items() if x.good}
    assert quality.classify(df.where("false")).count() == 0


# 6: licences


def test_licenses_against_brute_force(spark):
    own = texts() + ["MIT License MIT license CC-BY", "gnu general public license gnu GENERAL public-license", "cc by apache license mit license", "smit license"]
    got = {x.doc_id: tuple(x)[1:6] for x in licenses.scan_licenses(frame(spark, [(k, t, 1) for k, t in enumerate(own)], "doc_id long, text string, labels int")).collect()}
    for k, t in enumerate(own):
        ws = ALNUM.findall((t or "").translate(LOWER))
        places = [(i, label) for i in range(len(ws)) for p, label in licenses.BASE.items() if ws[i : i + len(p.split())] == p.split()]
        assert got[k] == (len(ws), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))


def plain_expression(tokens):
    """(labels, burden) of the longest expression that tokens start with, by recursive descent over every prefix."""

    def level(ts, k):
        if k == 3:
            if ts and ts[0] == "(":
                got = level(ts[1:], 0)
                return got and got[2][:1] == [")"] and (got[0], got[1], got[2][1:]) or None
            if not ts or ts[0] in (")", "or", "and", "with"):
                return None
            label, burden = licenses.identified(ts[0].rstrip(",;*/"))
            return {label}, burden, ts[1:]
        left = level(ts, k + 1)
        while left and left[2][:1] == [("or", "and", "with")[k]]:
            right = level(left[2][1:], k + 1)
            if not right:
                return None
            if k == 2:
                left = left[0], max(0, left[1] - 1), right[2]
            else:
                left = left[0] | right[0], (min, max)[k](left[1], right[1]), right[2]
        return left

    whole = [x for n in range(1, len(tokens) + 1) if (x := level(tokens[:n], 0)) and not x[2]]
    return whole[-1][:2] if whole else None


def test_labels_against_brute_force(spark):
    r = random.Random(11)
    names = ["MIT", "GPL-2.0-only", "Apache-2.0", "MPL-2.0", "foo", "CC-BY-NC-4.0", "(", ")", "OR", "AND", "WITH", "LGPL-2.1+", "x,"]
    phrases = [*licenses.BASE, *licenses.NOTICES]

    def line():
        return " ".join(r.choice([*licenses.TAGS, r.choice(phrases), "the"]) + " " + " ".join(r.choices(names, k=r.randint(0, 7))) for _ in range(r.randint(0, 3)))

    own = ["\n".join(line() for _ in range(r.randint(0, 4))) for _ in range(300)]
    got = {x.doc_id: x for x in licenses.scan_licenses(frame(spark, list(enumerate(own)), "doc_id long, text string")).collect()}
    for k, t in enumerate(own):
        low = t.translate(LOWER)
        ws = ALNUM.findall(low)
        doubt, labels, burden = 1.0, set(), None
        for table, share in ((licenses.BASE, 0.2), (licenses.NOTICES, 0.4)):
            for p, label in table.items():
                n = sum(ws[i : i + len(p.split())] == p.split() for i in range(len(ws)))
                doubt *= (0.6 if label == "notice" else share) ** n
                labels |= {label} if n and label != "notice" else set()
        for m in re.finditer("|".join(map(re.escape, licenses.TAGS)), low):
            rest = re.split("\n|" + "|".join(map(re.escape, licenses.TAGS)), low[m.end() :])[0]
            found = plain_expression(re.findall(r"[()]|[^\s()]+", rest))
            if found:
                labels |= found[0]
                burden = found[1] if burden is None else max(burden, found[1])
                doubt *= 0.05
        assert (got[k].labels, got[k].burden) == (",".join(sorted(labels)), burden) and abs(got[k].score - (1 - doubt)) < 1e-5


@pytest.mark.parametrize("name, want", [("mit", ("mit", 0)), ("agpl-3.0", ("agpl", 2)), ("lgpl-2.1", ("lgpl", 1)), ("0bsd", ("bsd", 0)), ("artistic-2.0", ("artistic", 1)), ("bsd-3-clause-clear", ("bsd", 0)), ("cc-by-nc-sa-4.0", ("cc-by-nc", 3)), ("cc-by-4.0", ("cc-by", 0)), ("gpl-2.0+", ("gpl", 2)), ("nothing-1.0", ("other", 3)), ("cc", ("other", 3)), ("-" * 99, ("other", 3))])
def test_identifiers(name, want):
    assert licenses.identified(name) == want


def test_licenses_take_linear_time():
    scan = licenses.scanner()
    for t in ("license-expression: " + "mit or " * 300_000 + "isc", "license-expression: " + "(" * 500_000 + "mit" + ")" * 500_000, "license-expression: mit and " * 100_000, "license-expression: " + " " * 5_000_000, "cc by " * 500_000):
        began = time.time()
        scan(t)
        assert time.time() - began < 10


@pytest.mark.parametrize("text, want", [("MIT OR GPL-2.0-only", ({"mit", "gpl"}, 0)), ("MIT AND GPL-2.0-only", ({"mit", "gpl"}, 2)), ("GPL-2.0-only WITH Classpath-exception-2.0 more", ({"gpl"}, 1)), ("(MIT OR GPL-2.0+) AND MPL-2.0", ({"mit", "gpl", "mpl"}, 1)), ("MIT OR MPL-2.0 AND GPL-3.0", ({"mit", "mpl", "gpl"}, 0)), ("MIT */", ({"mit"}, 0)), ("Foo", ({"other"}, 3))])
def test_expressions(text, want):
    assert licenses.evaluate(licenses.parse_expression(text)) == want


@pytest.mark.parametrize("text", ["", "OR MIT", "(MIT", ")"])
def test_no_expression(text):
    assert licenses.parse_expression(text) is None


# 7: pieces


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as f:
        return pieces.load_vocabulary(f.read())


def ways(v, text):
    if not text:
        return [((), 1.0)]
    out = [((v.weight[text[:j]][0], *rest), v.weight[text[:j]][1] * w) for j in range(1, len(text) + 1) if text[:j] in v.weight for rest, w in ways(v, text[j:])]
    if text[0] not in v.weight:
        raw = text[0].encode()
        out += [((*[v.byte[b] for b in raw], *rest), v.byte_weight ** len(raw) * w) for rest, w in ways(v, text[1:])]
    return out


@pytest.mark.parametrize("text", ["there", "a▁b", "né"])
def test_samples_follow_the_lattice(vocabulary, text):
    n = 20_000
    ids, at = pieces.encode([text] * n, textbytes.mix(np.arange(n, dtype=np.uint64)), pieces.Lattices(vocabulary))
    got = collections.Counter(tuple(ids[at[k] : at[k + 1]].tolist()) for k in range(n))
    every = ways(vocabulary, f" {text}")
    total = sum(w for _, w in every)
    for p, w in every:
        assert abs(got[p] / n - w / total) < 0.02
    best, _ = pieces.encode([text], np.zeros(1, np.uint64), pieces.Lattices(vocabulary, best=True))
    assert tuple(best.tolist()) == max(every, key=lambda x: x[1])[0]


def test_pieces_are_lossless_and_reproducible(spark, vocabulary):
    own = [*texts(), "▁", " ▁ ", "<s></s><0x0A>\n\t\u0000", "x" * 5000, " " * 100 + "y", "漢" * 300]
    rows = [(k, t, "q") for k, t in enumerate(own)] + [(None, "null key", "q")]
    df = frame(spark, rows, "doc_id long, text string, token_ids string")
    a = {x.doc_id: x for x in pieces.tokenize(df).collect()}
    b = {x.doc_id: x.token_ids for x in pieces.tokenize(df.repartition(1)).collect()}
    assert all(x.lossless for x in a.values()) and {i: x.token_ids for i, x in a.items()} == b
    for k, t in enumerate(own):
        assert pieces.decode(a[k].token_ids, vocabulary) == (t or "") and a[k].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    other = {x.doc_id: x.token_ids for x in pieces.tokenize(df, seed=1).collect()}
    assert other != b
    assert pieces.tokenize(df.where("false")).count() == 0


def test_pieces_of_long_segments(vocabulary, monkeypatch):
    r = random.Random(6)
    own = ["".join(r.choices("abcxyz漢 ", k=3000)), "x" * 50_000 + " y", "é" * 20_000, " " * 40_000, "a b"]
    keys = textbytes.mix(np.arange(len(own), dtype=np.uint64))
    ids, at = pieces.encode(own, keys, pieces.Lattices(vocabulary))
    assert [pieces.decode(ids[at[k] : at[k + 1]].tolist(), vocabulary) for k in range(len(own))] == own
    # However the work is cut, and whatever is kept or forgotten in between, the same pieces come out.
    monkeypatch.setattr(pieces, "_AT_ONCE", 700)
    again, places = pieces.encode(own, keys, pieces.Lattices(vocabulary))
    assert (again == ids).all() and (places == at).all()


def test_crc_of_the_query(spark):
    got = spark.createDataFrame([("aé",)], "t string").select(F.crc32(F.encode("t", "UTF-8")).alias("c")).first().c
    assert got == binascii.crc32("aé".encode())


# 7: long unbroken runs


@pytest.mark.parametrize("best", [False, True])
@pytest.mark.parametrize("kind", ["one letter", "letters", "pieces"])
def test_long_runs_have_the_draws_of_one_whole_lattice(best, kind):
    """Whatever the windows: a run of one letter, whose pieces remember their parity for long, random letters, and runs of pieces."""
    r = random.Random(3)
    run = {"one letter": "a" * 30_000, "letters": "".join(r.choices("abcdefghijklmnopqrstuvwxyzABC0123é漢\U00010348", k=30_000)), "pieces": "".join(r.choices(["the", "tion", "ing", "_", "Straße"], k=9_000))}[kind]
    with open(pieces.MODEL, "rb") as f:
        v = pieces.load_vocabulary(f.read())
    own, keys = ["plain words", run, f"x {run} y", "", None or "z"], textbytes.mix(np.arange(1, 6, dtype=np.uint64))
    whole = pieces.encode(own, keys, pieces.Lattices(v, best), window=1 << 30)
    for window in (1 << 14, 4096, 300):
        got = pieces.encode(own, keys, pieces.Lattices(v, best), window=window)
        assert np.array_equal(got[0], whole[0]) and np.array_equal(got[1], whole[1])
    assert pieces.decode(whole[0][whole[1][1] : whole[1][2]].tolist(), v) == run


# 9: names and types that clash


def test_shards_keep_columns_of_any_name_and_type(spark):
    rows = [(i, "s" if i % 3 else None, i, {"a": i}, f"t{i}", -1) for i in range(50)]
    df = spark.createDataFrame(rows, "Doc_ID long, Source string, before int, `a.map` map<string, int>, _ss_b string, SHARD int")
    out = sharding.stratified_shards(df, 4, rows_per_bucket=7)
    assert out.columns == ["Doc_ID", "Source", "before", "a.map", "_ss_b", "shard", "slot"]
    got = out.collect()
    assert sorted((r.Doc_ID, r.Source, r.before, r["a.map"]["a"], r._ss_b) for r in got) == sorted((i, s, b, m["a"], t) for i, s, b, m, t, _ in rows)
    assert sorted((r.shard, r.slot) for r in got) == [(k, s) for k, n in enumerate((13, 12, 13, 12)) for s in range(n)]
    assert sharding.stratified_shards(df.limit(0), 4).columns == out.columns


def test_stages_find_their_columns_whatever_the_case(spark):
    df = spark.createDataFrame([(1, "some words of prose that go on"), (2, None)], "DOC_ID long, Text string")
    bench = spark.createDataFrame([(1, "words of prose that go on")], "item_id long, text string")
    assert decontaminate.clean(df, bench).columns == df.columns and decontaminate.clean(df, bench).count() == 1
    assert quality.keep_good(df).columns == df.columns
    assert neardup.deduplicate(df).columns == df.columns and neardup.deduplicate(df).count() == 2


# 10: crowded buckets


@pytest.mark.parametrize("crowd", [4, 128])
def test_pages_of_one_template(spark, crowd):
    """Unlinked pages that share most of their words, and linked ones among them, whatever the bucket's limit."""
    r = random.Random(12)
    template = [f"t{k}" for k in range(140)]
    pages = [template + [f"p{i}x{k}" for k in range(60)] for i in range(120)]
    pages += [page[:198] + [f"q{i}", f"r{i}"] for i, page in enumerate(pages[:40])] + [page[:190] + [f"s{i}k{k}" for k in range(r.randrange(8, 16))] for i, page in enumerate(pages[:20])]
    rows = list(enumerate(" ".join(p) for p in pages))
    r.shuffle(rows)
    got = {tuple(x) for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), crowd=crowd).collect()}
    assert got == brute_groups(rows, 5, 80)


# 1: threshold and verdict


@pytest.mark.parametrize("false_rejects", [0.005, 0.05])
def test_url_threshold_by_counting_held_out_scores(spark, false_rejects):
    """The verdict of every url from its score and a threshold found by trying every bin over the held-out accepted urls."""
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefghilmnoprstu", k=r.randint(3, 8)))
    good = [f"https://{word()}.org/{word()}/{word()}-{r.randrange(99)}" for _ in range(900)]
    bad = [f"http://{r.choice(['casino', 'ads', 'porn'])}-{word()}.biz/{word()}?win={r.randrange(10**6)}" for _ in range(300)] + [f"http://{word()}.org/free-casino-win?win={r.randrange(10**6)}" for _ in range(40)]
    rows = list(enumerate(good + bad + [None, "", good[0]]))
    df = frame(spark, rows, "page_id long, url string")
    got = {x.page_id: (x.verdict, x.lm_score) for x in urlfilter.filter_urls(df, [], false_rejects=false_rejects).collect()}

    fold = {x.page_id: x.f for x in df.select("page_id", F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(5)).alias("f")).collect()}
    seeded = lambda u: bool(set(re.split(r"[.\-]", (re.search(r"://([^/?#]*)", u or "") or [None, ""])[1])) & set(urlfilter.SEED_WORDS))
    labelled = [(i, u, int(seeded(u)), fold[i] > 0) for i, u in rows]
    train = spark.createDataFrame(labelled, "page_id long, url string, label int, trains boolean")
    model = urlfilter.gram_scores(urlfilter.train(train, 4), 4).persist()
    score = {x.page_id: x.lm_score for x in urlfilter.score(df, model, 4).collect()}
    held = [score[i] for i, _, label, trains in labelled if not label and not trains]
    # Scores count by bins of 64 units, cut towards 0.
    allowed = int(len(held) * false_rejects)
    fits = [b for b in range(0, 16 * 65536 // 64 + 2) if sum(int(s / 64) >= b for s in held) <= allowed]
    threshold = 64 * min(fits)
    assert got == {i: ("block" if score[i] > threshold else "allow", score[i] / 65536) for i, _ in rows}
    assert sum(s > threshold for s in held) <= allowed and 0 < sum(v == "block" for v, _ in got.values()) < len(rows) / 2
