"""Text quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad. Its score is linear in its own features (lengths, kinds of characters,
repeated words) and in those of the lines before and after; a 2 x 2 matrix scores neighbouring labels.
Forward and backward sums give each line's probability of being good; their mean, weighted by line length,
is the quality of the text. For training, each line carries its text's label.

Fitting sees at most ``sample`` labelled texts of at most ``sample_chars`` characters, chosen by a hash
of the id, so it is bounded whatever the corpus; scoring sees every text as a whole. Only the text is
ever scored: no label, language, source or id is an input.

Null and empty texts, and texts of white space only, have no lines and score 0. Rows that repeat an id and a text
give repeated rows; a text whose id has several labels is left out of the fit; of several texts with one id, the fit
sees that of the least MD5. Ids that are no whole numbers are refused. Columns besides id and
text keep their names and values (``score`` and ``n_lines`` are replaced). Without labelled texts of both
kinds there is nothing to learn: every text with a line scores near 0 if all labels say bad, else near 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from logtide.llm.words import LOWER, U, WHITE, bytes_of, chain, mix, slices, whole_id, word_hashes, words_in

SAMPLE_CHARS = 50_000
SURE = 20.0

#: Kinds of bytes, counted for each line.
LETTER, UPPER, DIGIT, SPACE, STOP, LOUD, SYMBOL = range(7)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[list(range(97, 123)) + list(range(128, 256))] = LETTER
KIND[65:91] = UPPER
KIND[48:58] = DIGIT
KIND[list(b" \t\n\x0b\x0c\r")] = SPACE
KIND[list(b".,;:'\"-()")] = STOP
KIND[list(b"!?")] = LOUD
OWN = 15


def _repeated(key: np.ndarray) -> np.ndarray:
    """Entries whose value stands earlier already."""
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), bool)
    out[order[1:]] = key[order][1:] == key[order][:-1]
    return out


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word, its length in bytes, and the first line of each text."""
    raw, offsets = bytes_of(texts)
    # a line is a run without a line feed that does not cross texts
    not_feed = np.ones(256, bool)
    not_feed[10] = False
    lines = words_in(raw, offsets, not_feed)
    words = words_in(LOWER[raw], offsets, WHITE)
    line_of = np.searchsorted(lines.start, words.start, "right") - 1
    count = np.bincount(line_of, minlength=len(lines.start))
    keep = np.flatnonzero(count)
    n = len(keep)
    start, end = lines.start[keep], lines.end[keep]
    first = np.searchsorted(start, offsets)
    renumber = np.zeros(len(lines.start), np.int64)
    renumber[keep] = np.arange(n)
    line_of, count = renumber[line_of], count[keep].astype(float)
    if not n:
        return np.zeros((0, 3 * OWN)), np.zeros(0), first

    # one number for each byte of a kept line; bytes between lines count for nothing
    line_of_byte = np.full(len(raw), 8 * n, np.int32)
    for_line = np.repeat(np.arange(n, dtype=np.int32) * 8, end - start)
    inside = np.zeros(len(raw) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    line_of_byte[np.cumsum(inside[:-1], dtype=np.int8) > 0] = for_line
    kinds = np.bincount(line_of_byte + KIND[raw], minlength=8 * n + 8)[: 8 * n].reshape(n, 8).astype(float)
    size = (end - start).astype(float)
    letters = kinds[:, LETTER] + kinds[:, UPPER]

    hashes = word_hashes(words)
    text_of = words.owner()
    length = words.end - words.start
    share = lambda flags: np.bincount(line_of, weights=flags, minlength=n) / count
    again = np.zeros(len(hashes), bool)
    with np.errstate(over="ignore"):
        pairs = chain(hashes, 2) + text_of[: max(len(hashes) - 1, 0)].astype(U) * U(0x9E3779B97F4A7C15)
        again[: len(pairs)] = _repeated(mix(pairs)) & (text_of[1:] == text_of[:-1])
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
        line_text = np.searchsorted(offsets, start, "right").astype(U)
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes + (np.arange(len(hashes)) - np.searchsorted(line_of, line_of)).astype(U)))])
        edge = np.searchsorted(line_of, np.arange(n + 1))
        line_again = _repeated(mix(total[edge[1:]] - total[edge[:-1]] + line_text * U(0x9E3779B97F4A7C15)))
    last = KIND[raw[words.end - 1]]
    own = np.column_stack([
        np.log1p(size) / 5, np.log1p(count) / 5, letters / size, kinds[:, UPPER] / np.maximum(letters, 1),
        kinds[:, DIGIT] / size, kinds[:, STOP] / size, kinds[:, LOUD] / size, kinds[:, SYMBOL] / size,
        share(length) / 10, share(length <= 3), share((last == SYMBOL) | (last == LOUD)), share((last == SYMBOL) & (length == 1)), share(again), share(same), line_again,
    ])
    before, after = np.zeros_like(own), np.zeros_like(own)
    follows = np.ones(n, bool)
    follows[first[:-1][first[:-1] < n]] = False
    at = np.flatnonzero(follows)
    before[at], after[at - 1] = own[at - 1], own[at]
    return np.hstack([own, before, after]), size, first


def forward_backward(score: np.ndarray, first: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log-probabilities that each line is bad or good, log-partition of each text, and the forward and backward sums."""
    alpha, beta = np.empty_like(score), np.zeros_like(score)
    order = np.argsort(-np.diff(first), kind="stable")
    begin, lines = first[:-1][order], np.diff(first)[order]
    longest = int(lines.max(initial=0))
    live = np.searchsorted(-lines, -np.arange(longest), "left")  # texts with more than t lines
    total = np.zeros(len(lines))
    for t in range(longest):
        at = begin[: live[t]] + t
        if t == 0:
            alpha[at] = score[at]
        else:
            was = alpha[at - 1]
            for k in (0, 1):
                alpha[at, k] = score[at, k] + np.logaddexp(was[:, 0] + move[0, k], was[:, 1] + move[1, k])
    for t in range(longest - 2, -1, -1):
        at = begin[: live[t + 1]] + t
        ahead = beta[at + 1] + score[at + 1]
        for k in (0, 1):
            beta[at, k] = np.logaddexp(ahead[:, 0] + move[k, 0], ahead[:, 1] + move[k, 1])
    some = lines > 0
    ends = begin[some] + lines[some] - 1
    total[order[some]] = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    z = np.repeat(total, np.diff(first))
    return alpha + beta - z[:, None], total, alpha, beta


@dataclass
class LineCRF:
    """Standardising moments, line weights (for good against bad) with a bias, and transition scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    move: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        good = ((features - self.mean) / self.scale) @ self.weights + self.bias
        return np.column_stack([-good / 2, good / 2])

    def quality(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Quality of each text, its number of lines, and the probability of good and the text of every line."""
        features, size, first = line_features(texts)
        marginal = np.exp(forward_backward(self.scores(features), first, self.move)[0][:, 1]) if len(size) else np.zeros(0)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        weight = np.bincount(owner, weights=size, minlength=len(first) - 1)
        total = np.bincount(owner, weights=size * marginal, minlength=len(first) - 1)
        return np.clip(total / np.maximum(weight, 1), 0, 1), np.diff(first), marginal, owner


def fit_lines(features: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> LineCRF:
    """Weights of greatest penalised likelihood, by gradient steps with moment estimates (Adam)."""
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (features - mean) / scale
    label = np.repeat(labels, np.diff(first)).astype(int)
    follows = np.ones(len(label), bool)
    follows[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(follows)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at - 1], label[at]), 1)
    theta, m, v = np.zeros(x.shape[1] + 5), np.zeros(x.shape[1] + 5), np.zeros(x.shape[1] + 5)
    texts = max(len(first) - 1, 1)
    for step in range(1, rounds + 1):
        weights, bias, move = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        good = x @ weights + bias
        score = np.column_stack([-good / 2, good / 2])
        log_p, total, alpha, beta = forward_backward(score, first, move)
        wrong = np.exp(log_p[:, 1]) - label
        z = np.repeat(total, np.diff(first))
        pair = np.empty((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                pair[i, j] = np.exp(alpha[at - 1, i] + move[i, j] + score[at, j] + beta[at, j] - z[at]).sum()
        grad = np.concatenate([x.T @ wrong, [wrong.sum()], (pair - seen).ravel()]) / texts + penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineCRF(mean, scale, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2).copy())


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "_text"):
        features, _, first = line_features(part.column(2))
        rows = [features[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
        names = ["_id", "label", "mark", "features"]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(rows, pa.binary())], names)


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 4000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_chars: int = SAMPLE_CHARS,
) -> LineCRF:
    """Fit on at most ``sample`` rows of ``labels`` for which ``learn`` holds; texts above ``sample_chars`` characters are left out of them."""
    known = labels.where(learn).select(whole_id(labels, id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("_id IS NOT NULL AND label IN (0, 1)").groupBy("_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")
    ).where("label = most").drop("most")
    texts = docs.select(whole_id(docs, id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # ids and labels only: at most `sample` rows are sent
    rows = texts.where(F.length("_text") <= sample_chars).join(F.broadcast(chosen), "_id")
    rows = rows.select("_id", "label", "_text", F.md5("_text").alias("_mark"))
    got = rows.mapInArrow(_features_of, "_id long, label int, mark string, features binary")
    seen: dict[int, Row] = {}
    for r in got.toLocalIterator():  # one text for each id, whichever comes first
        if r["_id"] not in seen or r["mark"] < seen[r["_id"]]["mark"]:
            seen[r["_id"]] = r
    order = sorted(seen)
    parts = [np.frombuffer(bytes(seen[k]["features"]), np.float32).reshape(-1, 3 * OWN) for k in order]
    target = np.array([seen[k]["label"] for k in order], int)
    if len(set(target.tolist())) < 2:  # nothing to tell apart: all good, unless all labels say bad
        sure = -SURE if len(target) and not target.any() else SURE
        return LineCRF(np.zeros(3 * OWN), np.ones(3 * OWN), np.zeros(3 * OWN), sure, np.zeros((2, 2)))
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit_lines(np.concatenate(parts).astype(float), first, target)


def score_quality(docs: DataFrame, model: LineCRF, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``n_lines``."""
    rest = [c for c in docs.columns if c not in ("score", "n_lines")]
    place = rest.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, f"c{place}"):
            score, lines, _, _ = model.quality(part.column(place))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(score), pa.array(lines.astype(np.int32))], [*part.schema.names, "score", "n_lines"]
            )

    source = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)])
    kinds = ", ".join([*(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(rest)), "score double, n_lines int"])
    return source.mapInArrow(run, kinds).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(rest)], "score", "n_lines")


def label_lines(docs: DataFrame, model: LineCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line, good, p_good)`` for every line with a word; lines are numbered from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            _, lines, marginal, owner = model.quality(part.column(1))
            first = np.cumsum(lines) - lines
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(owner)),
                    pa.array((np.arange(len(owner)) - first[owner]).astype(np.int32)),
                    pa.array(marginal >= 0.5),
                    pa.array(marginal),
                ],
                ["_id", "line", "good", "p_good"],
            )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, line int, good boolean, p_good double").withColumnRenamed("_id", id_col)
