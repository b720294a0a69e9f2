"""URL filter: rules by host and path, then the ratio of two character Markov models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.common import arrow_map, read, stored
from waymark.llm.textbytes import string_bytes

#: (action, host, path) of the query's rules.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

#: Words of host names that mark a url as an example of a rejected one.
SEED_WORDS = ["ad", "adserver", "ads", "adult", "banner", "bet", "betting", "casino", "clicks", "gambling", "loan", "malware", "phish", "pills", "poker", "popup", "porn", "scam", "sex", "spam", "torrent", "tracker", "viagra", "warez", "xxx"]

_SYMBOLS = 64
_BITS = 6
#: So many grams are broadcast, 16 bytes each; urls meet the others by a join.
_MOST = 1 << 20
_UNIT = 65536


def _symbols() -> np.ndarray:
    """Classes of bytes: 0 ends a url, then letters of either case, digits, punctuation; 63 is the rest."""
    out = np.full(256, 63, dtype=np.int64)
    for k, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"):
        out[[ord(c), ord(c.upper())]] = k + 1
    return out


_CLASS = _symbols()


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """pages with host, path, rule and rule_verdict (null where no rule fits)."""
    rest = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    out = pages.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", r"(?s)^[^/?#]*", 0))
    out = out.withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"(?s)^[^?#]*", 0))
    out = out.withColumn("host", F.translate("_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return out.withColumn("rule", rule).withColumn("rule_verdict", verdict).drop("_rest", "_host")


def _places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the urls' symbols and one end each: row, symbol and place in the row; then the rows' lengths."""
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths + 1)
    starts = offsets[:-1] + np.arange(len(lengths))
    symbol = np.zeros(len(row), dtype=np.int64)
    inner = np.ones(len(row), dtype=bool)
    inner[starts + lengths] = False
    symbol[inner] = _CLASS[data]
    return row, symbol, np.arange(len(row)) - starts[row], lengths + 1


def _back(symbol: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The symbol k places before each, 0 before a row's first."""
    back = np.zeros(len(symbol), dtype=np.int64)
    back[k:] = symbol[:-k]
    back[at < k] = 0
    return back


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the urls' symbols and one end each: the row, and the symbol below its `order` symbols of context, six bits each; then lengths."""
    row, gram, at, lengths = _places(data, offsets)
    symbol = gram.copy()
    for k in range(1, order + 1):
        gram |= _back(symbol, at, k) << (_BITS * k)
    return row, gram, lengths


def _slices(column: pa.Array, chunk: int = 1 << 18):
    data, offsets = string_bytes(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def train(labelled: DataFrame, order: int) -> DataFrame:
    """(gram, n, n0, n1): how often each gram is in the urls of (url, label, trains), and in those that train of label 0 and 1."""

    def count(batch: pa.RecordBatch):
        label, trains = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), dtype=np.int64) for c in (1, 2))
        kind = np.where(trains > 0, 1 + label, 0)
        for a, b, data, offsets in _slices(batch.column(0)):
            row, gram, _ = _grams(data, offsets, order)
            each, n = np.unique(gram * 3 + kind[a:b][row], return_counts=True)
            columns = [each // 3, n, n * (each % 3 == 1), n * (each % 3 == 2)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["gram", "n", "n0", "n1"])

    counted = arrow_map(labelled.select("url", "label", F.col("trains").cast("int")), "gram long, n long, n0 long, n1 long", count)
    return counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")])


def gram_scores(counts: DataFrame, order: int) -> DataFrame:
    """(gram, n, score) for every gram of train(): log2 p(rejected model) - log2 p(accepted model), in 1 / 65536 bits.

    Witten-Bell: each order leans on the next shorter one, the shortest on 1 / 64. A shorter context's counts are
    sums of the longest ones', so every order is a groupBy of the table, joined to its contexts and to the order below.
    """
    below = None
    for k in range(order + 1):
        own = counts.groupBy(F.col("gram").bitwiseAND(F.lit((1 << _BITS * (k + 1)) - 1)).alias("gram")).agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")])
        own = own.withColumn("_context", F.shiftright("gram", _BITS))
        totals = own.groupBy("_context").agg(*[f.alias(f"{n}{c}") for c in (0, 1) for n, f in (("total", F.sum(f"n{c}")), ("kinds", F.count_if(F.col(f"n{c}") > 0)))])
        both = own.join(totals, "_context")
        if below is None:
            both = both.withColumns({f"_p{c}": F.lit(1 / _SYMBOLS) for c in (0, 1)})
        else:
            both = both.withColumn("_shorter", F.col("gram").bitwiseAND(F.lit((1 << _BITS * k) - 1))).join(below, "_shorter")
        p = [F.when(F.col(f"total{c}") > 0, (F.col(f"n{c}") + F.col(f"kinds{c}") * F.col(f"_p{c}")) / (F.col(f"total{c}") + F.col(f"kinds{c}"))).otherwise(F.col(f"_p{c}")) for c in (0, 1)]
        mixed = both.select("gram", "n", p[0].alias("_p0"), p[1].alias("_p1"))
        below = mixed.select(F.col("gram").alias("_shorter"), "_p0", "_p1")
    return mixed.select("gram", "n", F.round((F.log2("_p1") - F.log2("_p0")) * _UNIT).cast("long").alias("score"))


def _known(column: pa.Array, table: tuple[np.ndarray, np.ndarray], order: int):
    """Slices of urls: first and last row, rows, grams, where in the table they are and whether, lengths."""
    grams, _ = table
    for a, b, data, offsets in _slices(column):
        row, gram, lengths = _grams(data, offsets, order)
        at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
        yield a, b, row, gram, at, grams[at] == gram, lengths


def score(pages: DataFrame, model: DataFrame, order: int, most: int = _MOST, url_col: str = "url") -> DataFrame:
    """pages with lm_score, the ratio in bits a character times 65536, rounded down; sums are exact.

    model (gram, n, score) has every gram of the urls. Its `most` most frequent ones are broadcast. If there are
    more, distinct urls are numbered, and what isn't broadcast is joined by a shuffle: the same scores, and no
    frequent gram is a join key.
    """
    size = model.count()
    if not size:
        return pages.withColumn("lm_score", F.lit(0).cast("long"))
    head = model if size <= most else model.orderBy(F.desc("n"), "gram").limit(most)
    head = head.select("gram", "score").toArrow()
    grams, values = (head[c].to_numpy() for c in ("gram", "score"))
    by = np.argsort(grams)
    shared = pages.sparkSession.sparkContext.broadcast((grams[by], values[by]))
    names = pages.columns

    def whole(batch: pa.RecordBatch):
        out = np.zeros(batch.num_rows, dtype=np.int64)
        for a, b, row, _, at, _, lengths in _known(batch.column(names.index(url_col)), shared.value, order):
            sums = np.concatenate([[0], np.cumsum(shared.value[1][at])])
            ends = np.cumsum(lengths)
            out[a:b] = (sums[ends] - sums[ends - lengths]) // lengths
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, "lm_score"])

    if size <= most:
        return arrow_map(pages, T.StructType([*pages.schema.fields, T.StructField("lm_score", T.LongType())]), whole)

    def parts(batch: pa.RecordBatch):
        """A row a url of what is known (keyed by a number no gram has), and one for every other gram of it."""
        ids = batch.column(1).to_numpy()
        for a, b, row, gram, at, hit, lengths in _known(batch.column(0), shared.value, order):
            sums = np.concatenate([[0], np.cumsum(np.where(hit, shared.value[1][at], 0))])
            ends = np.cumsum(lengths)
            own, rest = ids[a:b], ids[a:b][row[~hit]]
            columns = [(own, rest), (-1 - own, gram[~hit]), (lengths, np.zeros(len(rest))), (sums[ends] - sums[ends - lengths], np.zeros(len(rest)))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names=["_id", "gram", "_length", "_sum"])

    keyed = pages.withColumn("_url", F.coalesce(F.col(url_col), F.lit("")))
    urls = stored(keyed.select("_url").distinct().withColumn("_id", F.monotonically_increasing_id()), "urls")
    split = arrow_map(urls, "_id long, gram long, _length long, _sum long", parts)
    summed = split.join(model.select("gram", "score"), "gram", "left").groupBy("_id").agg(F.sum("_length").alias("_length"), F.sum(F.col("_sum") + F.coalesce("score", F.lit(0))).alias("_sum"))
    scored = urls.join(summed, "_id").select("_url", F.expr("(_sum - pmod(_sum, _length)) div _length").alias("lm_score"))
    return keyed.join(scored, "_url").select(*names, "lm_score")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], seed_words: list[str] = SEED_WORDS, order: int = 4, false_rejects: float = 0.005, url_col: str = "url", id_col: str = "page_id", most: int = _MOST) -> DataFrame:
    """(page_id, host, path, rule, verdict, lm_score) for every row.

    The longest rule that fits decides. The other urls are judged by two variable-order Markov models
    (contexts of 0 to 4 characters, Witten-Bell smoothing) of examples of rejected and of accepted urls:
    those whose host has one of seed_words between dots or hyphens, and all others. Every url of the table
    counts; four fifths (by hash of the url) train, one fifth calibrates: the threshold is the least score
    that rejects at most `false_rejects` of the accepted examples held out. A url is blocked whose
    length-normalised log-likelihood difference is above it.

    Counts are kept by the true context and symbol, so the models grow with the distinct contexts of the table.
    They stay distributed; the `most` most frequent grams are gathered and broadcast, the others joined (see
    score()). The histogram of held-out scores has a fixed size.

    Cases: a null url or one without `://` has empty host and path, fits no rule and is judged as its text
    (null: empty). Without examples of rejected urls the method allows all. Equal rows get equal
    results; no rows: none. Columns besides id_col and url_col are not read.
    """
    plain = with_rule(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), rules)
    seeds = F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*[F.lit(w) for w in seed_words]))
    labelled = plain.withColumn("label", seeds.cast("int")).withColumn("fold", F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(5)))
    counts = stored(train(labelled.withColumn("trains", F.col("fold") > 0), order), "grams")
    seen = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not seen["n0"] or not seen["n1"]:
        return plain.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("lm_score"))
    model = stored(gram_scores(counts, order), "gram-scores")
    held = score(labelled.where("fold = 0 and label = 0").select("url"), model, order, most)
    limit = _UNIT * 16
    bins = held.select(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.col("lm_score"))).alias("s")).selectExpr("s div 64 as bin").groupBy("bin").count().collect()
    allowed, above = int(sum(r["count"] for r in bins) * false_rejects), 0
    threshold = 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        above += r["count"]
        if above > allowed:
            threshold = max(0, (r["bin"] + 1) * 64)
            break
    judged = score(plain, model, order, most)
    method = F.when(F.col("lm_score") > threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), (F.col("lm_score") / _UNIT).alias("lm_score"))


def op1_url_markov_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages, by the rules above and else by the models."""
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), RULES)
