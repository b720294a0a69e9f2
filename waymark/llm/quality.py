"""Quality classifier: a label model over heuristic labellers, whose posteriors train a hashed linear scorer."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import arrow_map, column_at, read
from waymark.llm.textbytes import NON_SPACE, U64, Words, mix, string_bytes, words

#: Frequent function words of four languages.
FUNCTION_WORDS = "a an and are as at be by for from in is it of on or that the this to was were with au aux dans de des du en est et la le les ou par pas pour que qui sur un une auf das dem den der des die ein eine für ist mit nicht und von zu als con del el ella en es la las lo los no para por se su un una y".split()

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!#$%&*+/<=>@\\^_`{|}~"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!"]] = True

LABELLERS = ("marks", "shouting", "function words", "sentences", "distinct words", "stutter", "distinct pairs", "dominant word", "letters", "word length", "digits")
REJECT, ABSTAIN, ACCEPT = 0, 1, 2


def _function_hashes() -> np.ndarray:
    return np.unique(np.concatenate([w.hash for w in words(pa.array(FUNCTION_WORDS), NON_SPACE)]))


def _measures(w: Words, data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each row; data holds the rows' bytes as they are."""

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def per_word(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[w.first_word[1:]] - total[w.first_word[:-1]]

    n = np.diff(w.first_word)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((w.hash, row))
    again = np.zeros(len(row), bool)
    again[1:] = (w.hash[order][1:] == w.hash[order][:-1]) & (row[order][1:] == row[order][:-1])
    near = np.zeros(len(row), bool)
    near[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    # Pairs of neighbours that have stood before, and the longest run of one word in sorted order.
    pair = mix(w.hash[1:] * U64(3) + w.hash[:-1])[row[1:] == row[:-1]] if len(row) > 1 else w.hash[:0]
    of = row[1:][row[1:] == row[:-1]] if len(row) > 1 else row[:0]
    at = np.lexsort((pair, of))
    twice = np.zeros(len(pair), bool)
    twice[1:] = (pair[at][1:] == pair[at][:-1]) & (of[at][1:] == of[at][:-1])
    most = np.zeros(len(n), np.int64)
    if len(row):
        first = np.flatnonzero(~again)
        np.maximum.at(most, row[order][first], np.diff(np.append(first, len(row))))
    return {
        "bytes": np.diff(offsets), "words": n, "upper": per_row(_UPPER[data]), "letters": per_row(_LETTER[data]), "digits": per_row(_DIGIT[data]), "marks": per_row(_MARK[data]), "stops": per_row(_STOP[data]),
        "known": per_word(known[np.minimum(np.searchsorted(known, w.hash), len(known) - 1)] == w.hash), "again": np.bincount(row[order][again], minlength=len(n)), "near": per_word(near), "twice": np.bincount(of[at][twice], minlength=len(n)), "most": most, "long": per_word(w.end - w.start > 30),
    }


def _votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, labellers) of 0 reject, 1 abstain, 2 accept."""
    n, size, letters = np.maximum(m["words"], 1), np.maximum(m["bytes"], 1), np.maximum(m["letters"], 1)

    def vote(reject, accept):
        return np.where(reject, REJECT, np.where(accept, ACCEPT, ABSTAIN))

    some = m["words"] >= 5
    out = np.stack([
        vote(m["marks"] > 0.15 * n, (m["marks"] < 0.03 * n) & some),
        vote((m["upper"] > 0.5 * letters) & some, (m["upper"] < 0.25 * letters) & some),
        vote((m["known"] < 0.03 * n) & (n >= 20), (m["known"] > 0.10 * n) & some),
        vote((m["stops"] == 0) & (n >= 30), (m["stops"] * 60 > n) & (m["stops"] < 0.5 * n) & some),
        vote((m["again"] > 0.8 * n) & (n >= 50) & (n < 400), (m["again"] < 0.6 * n) & (n >= 20)),
        vote((m["near"] > 0.1 * n) & (n >= 20), (m["near"] < 0.03 * n) & (n >= 20)),
        vote((m["twice"] > 0.5 * n) & (n >= 20), (m["twice"] < 0.25 * n) & (n >= 20)),
        vote((m["most"] > 0.25 * n) & (n >= 20), (m["most"] < 0.15 * n) & (n >= 20)),
        vote(m["letters"] < 0.6 * size, (m["letters"] > 0.7 * size) & some),
        vote((size > 13 * n) & some | (m["long"] > 0.1 * n) & some, (size < 11 * n) & some),
        vote(m["digits"] > 0.2 * size, (m["digits"] < 0.05 * size) & some),
    ], axis=1)
    out[m["words"] == 0] = REJECT
    return out


@dataclass
class LabelModel:
    """prior: share of good documents; p[c, j, v]: chance that labeller j, if it doesn't abstain, votes v on class c (0 bad, 1 good)."""

    prior: float
    p: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        j, said = np.arange(votes.shape[1]), votes != ABSTAIN
        logs = [np.log(x) + (np.log(self.p[c, j, votes]) * said).sum(axis=1) for c, x in ((0, 1 - self.prior), (1, self.prior))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))

    def accuracies(self) -> np.ndarray:
        """Of each labeller where it votes."""
        right = self.prior * self.p[1, :, ACCEPT] + (1 - self.prior) * self.p[0, :, REJECT]
        wrong = self.prior * self.p[1, :, REJECT] + (1 - self.prior) * self.p[0, :, ACCEPT]
        return right / (right + wrong)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and their counts; labellers are taken as independent given the class."""
    balance = (votes == ACCEPT).sum(axis=1) - (votes == REJECT).sum(axis=1) * 2.0
    good = 1 / (1 + np.exp(-balance))
    model = LabelModel(0.5, np.full((2, votes.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        p = np.empty_like(model.p)
        for c, weight in ((0, counts * (1 - good)), (1, counts * good)):
            for v in range(3):
                p[c, :, v] = ((votes == v) * weight[:, None]).sum(axis=0) + 1.0
        p[:, :, ABSTAIN] = 0
        p /= p.sum(axis=2, keepdims=True)
        p[:, :, ABSTAIN] = 1
        prior = float(np.clip((counts * good).sum() / counts.sum(), 1e-3, 1 - 1e-3))
        model = LabelModel(prior, p)
        new = model.posterior(votes)
        if np.abs(new - good).max() < 1e-6:
            break
        good = new
    return model


def _grams(data: np.ndarray, bits: int) -> np.ndarray:
    """Hashed three-byte features, one for each place but the last two."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    x = data.astype(np.uint64)
    return (mix((x[:-2] << U64(16)) | (x[1:-1] << U64(8)) | x[2:]) >> U64(64 - bits)).astype(np.int64)


def _features(data: np.ndarray, bits: int, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells and values of one text: roots of the shares of hashed features, and of three measures of repetition."""
    n = np.bincount(_grams(data, bits), minlength=1 << bits)
    k = np.flatnonzero(n)
    return np.append(k, (1 << bits) + np.arange(len(repeats))), np.append(np.sqrt(n[k] / max(1, n.sum())), repeats)


def _repeats(m: dict[str, np.ndarray]) -> np.ndarray:
    return np.sqrt(np.stack([m["near"], m["twice"], m["most"]], axis=1) / np.maximum(m["words"], 1)[:, None])


def fit_linear(rows: np.ndarray, cells: np.ndarray, values: np.ndarray, target: np.ndarray, bits: int, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression of posteriors on sparse shares of features; full-batch Adam, so the same each time."""
    w, b = np.zeros((1 << bits) + 3), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    n = len(target)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=w[cells] * values, minlength=n) + b
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        g = np.bincount(cells, weights=gap[rows] * values, minlength=len(w)) / n + 1e-6 * w
        gb = gap.mean()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        b -= 0.3 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    return w, b


def _chunks(column: pa.Array):
    """Words of runs of rows, with the rows' own bytes."""
    data, offsets = string_bytes(column)
    for w in words(column, NON_SPACE):
        at = offsets[w.first : w.last + 1]
        yield w, data[at[0] : at[-1]], at - at[0]


@dataclass
class Classifier:
    """What judging needs: the label model and the linear scorer."""

    model: LabelModel
    weights: np.ndarray | None
    bias: float
    bits: int
    threshold: float

    def judge(self, column: pa.Array):
        """(first row, last row, scores, posteriors, decisions) of runs of rows."""
        known = _function_hashes()
        for w, data, at in _chunks(column):
            m = _measures(w, data, at, known)
            posterior, again = self.model.posterior(_votes(m)), _repeats(m)
            score = np.zeros(len(posterior))
            for r in np.flatnonzero(m["words"] > 0):
                if self.weights is None:
                    score[r] = posterior[r]
                    continue
                cells, values = _features(data[at[r] : at[r + 1]], self.bits, again[r])
                score[r] = 1 / (1 + np.exp(-np.clip((self.weights[cells] * values).sum() + self.bias, -30, 30)))
            yield w.first, w.last, score.round(6), posterior.round(6), (score >= self.threshold) & (m["words"] > 0)


def fit(docs: DataFrame, sample: int = 4000, bits: int = 14, threshold: float = 0.5, text_col: str = "text") -> Classifier:
    """Fit the label model on all rows, and the scorer on its posteriors for a bounded sample.

    Eleven heuristic labellers accept, reject or abstain on the whole text. Expectation-maximisation
    over the counts of vote patterns of all documents (3**11 at most, whatever the input) estimates
    their accuracies and the share of good documents. The posterior labels of the `sample` distinct texts
    of smallest hash (all, if there are fewer) train a linear scorer of hashed three-byte features, each by the root of
    its share of the text, and three measures of repetition. If none of those texts
    has a word, the posterior is the score. Without any rows the classifier rejects all.
    """
    plain = docs.select(F.col(text_col).alias("text"))
    known = _function_hashes()

    def patterns(batches):
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for batch in batches:
            for w, data, at in _chunks(batch.column(0)):
                code = _votes(_measures(w, data, at, known)) @ (3 ** np.arange(len(LABELLERS)))
                total += np.bincount(code, minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["code", "n"])

    found = plain.select("text").mapInArrow(patterns, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    total = sum(r["n"] for r in found)
    if not total:
        return Classifier(LabelModel(0.5, np.full((2, len(LABELLERS), 3), 0.5)), np.zeros((1 << bits) + 3), -30.0, bits, threshold)
    codes = np.array([r["code"] for r in found])
    model = fit_label_model(codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3, np.array([r["n"] for r in found], float))

    # The texts of the `sample` smallest hashes; a text counts once, however many rows repeat it.
    keyed = plain.where(F.col("text").isNotNull()).withColumn("_key", F.xxhash64("text", F.lit(5)))
    last = keyed.select("_key").distinct().orderBy("_key").limit(sample).agg(F.max("_key")).first()[0]
    picked = keyed.where(F.col("_key") <= F.lit(last)).select("text").distinct()

    def features(batch: pa.RecordBatch):
        for w, data, at in _chunks(batch.column(0)):
            m = _measures(w, data, at, known)
            good, again = model.posterior(_votes(m)), _repeats(m)
            for r in np.flatnonzero(m["words"] > 0):
                cells, values = _features(data[at[r] : at[r + 1]], bits, again[r])
                yield pa.RecordBatch.from_arrays([pa.array([float(good[r])]), pa.array([cells.astype(np.int32)], pa.list_(pa.int32())), pa.array([values.astype(np.float32)], pa.list_(pa.float32()))], names=["good", "cells", "values"])

    # Each of the sampled texts has 2**bits features at most; copies of one text count once.
    rows = arrow_map(picked, "good double, cells array<int>, values array<float>", features).dropDuplicates(["good", "cells", "values"]).orderBy(F.xxhash64("cells", "values"), "good").limit(2 * sample).toArrow()
    weights, bias = None, 0.0
    if len(rows):
        cells, values = rows["cells"].combine_chunks(), rows["values"].combine_chunks()
        lengths = np.diff(cells.offsets.to_numpy())
        weights, bias = fit_linear(np.repeat(np.arange(len(rows)), lengths), cells.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(np.float64), rows["good"].to_numpy(), bits)
    return Classifier(model, weights, bias, bits, threshold)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, score, posterior, good) for every row, by a classifier fitted to all of docs (options: see fit()).

    score is the scorer's chance that the text is good, posterior the label model's; good is
    score >= threshold.

    Cases: a null, empty or wordless text is rejected with score 0; a very long text counts whole; equal
    texts get equal scores; no rows: none. Other columns are not read.
    """
    own = fit(docs, text_col=text_col, **options)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def one(batch: pa.RecordBatch):
        for a, b, score, posterior, good in own.judge(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score), pa.array(posterior), pa.array(good)], names=["doc_id", "score", "posterior", "good"])

    return arrow_map(plain, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, score double, posterior double, good boolean", one)


def keep_good(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, that classify() calls good; the same cases hold."""
    own = fit(docs, text_col=text_col, **options)
    at = column_at(docs, text_col)

    def one(batch: pa.RecordBatch):
        for a, b, _, _, good in own.judge(batch.column(at)):
            yield batch.slice(a, b - a).filter(pa.array(good))

    return arrow_map(docs, docs.schema, one)


def op5_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return classify(read(spark, sf_dir, "documents"))
