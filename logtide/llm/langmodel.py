"""Log-probabilities of whole texts under a gated recurrent language model learnt from the corpus.

1. Words of the texts to learn from are counted, by 128-bit names; all counts stay in a written table.
2. Words with at least a certain count, at most ``COUNTED`` of them, are sent to the tasks that turn texts into ids. The most
   frequent ones have an id of their own, all others share one. What a task cannot count by itself it leaves as
   (text, word) rows, which meet the table of counts in a join.
3. Training goes in rounds. In each, every task trains a copy of the model on its own texts of that round, and the copies are
   averaged in a tree (:mod:`logtide.llm.recurrent` has the model). Every text to learn from is read once, as a whole.
4. Scoring reads every text as a whole. A word without an id has the probability of "another word", from the
   model, times its share among those, from the counts (plus one, with one word for all that were never seen).

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. Null and empty texts are an end alone. Rows that
repeat an id are texts of their own; a null id is learnt from unless ``held`` says otherwise. Without texts to learn from,
all counts are 0 and the model tells nothing apart. Columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.recurrent import GatedModel, one_core
from logtide.llm.words import distinct, find_words, give_back, slices
from logtide.scratch import materialize

CLASSES = MEMBERS = 32
STATE = 16
ROUNDS = 4
RATE = 0.1
#: Words whose counts are sent to every task.
COUNTED = 262_144
#: A task's counts before they are merged, tokens of one training pass, and of one scoring pass.
HELD_WORDS, TRAIN_TOKENS, SCORE_TOKENS = 2_000_000, 1_000_000, 4_000_000
LANES = (16, 512)
TOKENS_PER_LANE = 2048


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    one, two, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    begin = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
    return one[begin], two[begin], np.add.reduceat(n[order], begin)


def word_counts(texts: DataFrame) -> DataFrame:
    """``(a, b, c)``: the two hashes and the count of each word of ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def rows() -> pa.RecordBatch:
            one, two, n = _merged(held)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (one, two, n)], ["a", "b", "c"])

        for part in slices(batches, "_text"):
            words = find_words(part.column(0))
            if len(words.start):
                one, two, _, inverse = distinct(words)
                held.append((one, two, np.bincount(inverse)))
            if sum(len(x[0]) for x in held) > HELD_WORDS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_WORDS // 2:
                    yield rows()
                    held = []
        if held:
            yield rows()

    return texts.mapInArrow(run, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Counts of the corpus: words with ``least`` or more, ordered by their first hash, and what all words add up to."""

    one: np.ndarray
    two: np.ndarray
    count: np.ndarray
    ids: np.ndarray  #: ``CLASSES * MEMBERS`` for words without an id of their own
    least: int
    texts: int
    tokens: int
    words: int
    frequent: np.ndarray  #: counts by id; the end token is one of them
    end: int

    @property
    def other(self) -> int:
        return CLASSES * MEMBERS

    @property
    def other_tokens(self) -> int:
        return self.tokens - int(self.frequent.sum())

    @property
    def other_words(self) -> int:
        return self.words - int((self.frequent > 0).sum())

    def look_up(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The row of each word, or -1."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)


def read_lexicon(counts: DataFrame, texts: int) -> Lexicon:
    """From a table of counts; ``texts`` is the number of ends."""
    # counts up to 1,024 one by one, then by eighths of powers of two: few rows, whatever the corpus
    step = F.pow(F.lit(2.0), F.floor(F.log2("c") * 8) / 8)
    level = F.when(F.col("c") <= 1024, F.col("c")).otherwise(F.greatest(F.ceil(step), F.lit(1025)))
    levels = counts.groupBy(level.cast("long").alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
    least, held = 1 << 62, 0
    for n, low in sorted(((r["n"], r["level"]) for r in levels), key=lambda x: -x[1]):
        if held + n > COUNTED:
            break
        least, held = low, held + n
    table = counts.where(F.col("c") >= least).toArrow()  # at most COUNTED rows
    one, two = (table.column(k).to_numpy().view(np.uint64) for k in ("a", "b"))
    count = table.column("c").to_numpy()
    order = np.argsort(one, kind="stable")
    one, two, count = one[order], two[order], count[order]
    best = np.lexsort((two, one, -count))[: CLASSES * MEMBERS - 1]
    end = int((count[best] > texts).sum())  # the end takes its place by count
    ids = np.full(len(one), CLASSES * MEMBERS, np.int32)
    ids[best] = np.arange(len(best)) + (np.arange(len(best)) >= end)
    frequent = np.insert(count[best], end, texts)
    tokens = sum(r["c"] for r in levels) + texts
    words = sum(r["n"] for r in levels) + (texts > 0)
    return Lexicon(one, two, count, ids, least, texts, tokens, words, frequent, end)


REST = "array<struct<a: bigint, b: bigint, n: bigint>>"
ENCODED = f"n_tokens long, n_known long, n_other long, counted double, counted_other double, ids binary, rest {REST}"


def encode(part: pa.Array, lexicon: Lexicon) -> list[pa.Array]:
    """For each text the columns of ``ENCODED``: sums over words that the lexicon counts, token ids, and the words it doesn't count."""
    words = find_words(part)
    texts = len(part)
    owner, lengths = words.owner(), np.diff(words.first)
    one, two, _, inverse = distinct(words)
    at = lexicon.look_up(one, two)
    found = at >= 0
    ids = np.full(len(one), lexicon.other, np.int32)
    logs = np.zeros(len(one))
    ids[found], logs[found] = lexicon.ids[at[found]], np.log10(lexicon.count[at[found]] + 1.0)
    token_ids, token_logs = ids[inverse], logs[inverse]
    others = token_ids == lexicon.other
    total = lambda w: np.bincount(owner, weights=w, minlength=texts).astype(float)
    end_log = np.log10(lexicon.texts + 1.0)
    known = total(found[inverse]).astype(np.int64) + (lexicon.texts > 0)
    n_other = total(others).astype(np.int64)

    out = np.empty(len(token_ids) + texts, np.uint16)
    out[words.first[1:] + np.arange(texts)] = lexicon.end
    out[np.arange(len(token_ids)) + owner] = token_ids
    sizes = np.concatenate([[0], np.cumsum(2 * (lengths + 1))]).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(sizes), pa.py_buffer(out)])

    missing = np.flatnonzero(~found[inverse])
    key, n = np.unique(owner[missing] * max(len(one), 1) + inverse[missing], return_counts=True)
    text, word = np.divmod(key, max(len(one), 1))
    rest = pa.StructArray.from_arrays(
        [pa.array(one[word].view(np.int64)), pa.array(two[word].view(np.int64)), pa.array(n.astype(np.int64))], ["a", "b", "n"]
    )
    offsets = pa.array(np.searchsorted(text, np.arange(texts + 1)).astype(np.int32))
    return [
        pa.array(lengths + 1), pa.array(known), pa.array(n_other), pa.array(total(token_logs) + end_log),
        pa.array(total(token_logs * others)), blobs, pa.ListArray.from_arrays(offsets, rest),
    ]


def encoded_texts(source: DataFrame, lexicon: Lexicon, kind: str) -> DataFrame:
    held = source.sparkSession.sparkContext.broadcast(lexicon)  # at most COUNTED words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            columns = encode(part.column(3), held.value)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names)

    names = ["_row", "_id", "_held", "n_tokens", "n_known", "n_other", "counted", "counted_other", "ids", "rest"]
    return source.mapInArrow(run, f"_row long, _id {kind}, _held boolean, {ENCODED}")


def gathered(batches: Iterator[pa.RecordBatch], column: int, tokens: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches until they hold ``tokens`` ids, with those ids and where each text starts."""
    one_core()
    parts, size = [], 0

    def made() -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]:
        blobs = [b for p in parts for b in p.column(column).to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(b) // 2 for b in blobs])])
        return parts, np.frombuffer(b"".join(blobs), np.uint16).astype(np.int32), first

    for part in slices(batches, "ids"):
        parts.append(part)
        size += part.column(column).nbytes // 2
        if size >= tokens:
            yield made()
            parts, size = [], 0
    if parts:
        yield made()
    give_back()


def train_rounds(encoded: DataFrame, model: GatedModel, rounds: int = ROUNDS, rate: float = RATE) -> GatedModel:
    """The model after as many rounds, each over its own share of the texts."""
    context = encoded.sparkSession.sparkContext
    past = np.full_like(model.flat(), 1e-6)
    for k in range(rounds):
        start = context.broadcast((model, past))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begun, held = start.value
            own, own_past, n = begun.with_flat(begun.flat()), begun.with_flat(held).p, 0
            for _, ids, first in gathered(batches, 0, TRAIN_TOKENS):
                lanes = int(np.clip(len(ids) // TOKENS_PER_LANE, *LANES))
                own.train(ids, first, own_past, rate, lanes)
                n += len(ids)
            if n:
                values = np.concatenate([own.flat(), GatedModel(own.classes, own.members, own.end, own_past).flat()])
                yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([values.tobytes()], pa.binary())], ["n", "values"])

        share = encoded.where((F.pmod(F.xxhash64("_row"), F.lit(rounds)) == k) & ~F.col("_held")).select("ids")
        copies = share.mapInArrow(run, "n double, values binary").rdd.map(
            lambda r: (r["n"], r["n"] * np.frombuffer(bytes(r["values"]), np.float32).astype(float))
        )
        add = lambda a, b: b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1])
        found = copies.treeAggregate(None, add, add, depth=2)
        start.unpersist()
        if found:
            mean = (found[1] / found[0]).astype(np.float32)
            model, past = model.with_flat(mean[: len(past)]), mean[len(past) :]
    return model


def recurrent_scores(encoded: DataFrame, model: GatedModel) -> DataFrame:
    """``(_row, model_score)``: the log10-probability of each text's ids."""
    held = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, ids, first in gathered(batches, 1, SCORE_TOKENS):
            rows = pa.chunked_array([p.column(0) for p in parts]).combine_chunks()
            yield pa.RecordBatch.from_arrays([rows, pa.array(held.value.score(ids, first) / np.log(10))], ["_row", "model_score"])

    return encoded.select("_row", "ids").mapInArrow(run, "_row long, model_score double")


def language_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row; rows with ``held`` are not learnt from."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept_out = F.coalesce(held, F.lit(False))
    learnt = docs.where(~kept_out)
    counts = materialize(word_counts(learnt.select(text.alias("_text"))), "word-counts")
    lexicon = read_lexicon(counts, learnt.count())
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), kept_out.alias("_held"), text.alias("_text"))
    encoded = materialize(encoded_texts(source, lexicon, docs.schema[id_col].dataType.simpleString()), "encoded")
    model = GatedModel.start(lexicon.frequent, lexicon.other_tokens, CLASSES, MEMBERS, lexicon.end, STATE)
    model = train_rounds(encoded, model, rounds)

    rare = encoded.select("_row", F.inline("rest")).join(counts.where(F.col("c") < lexicon.least), ["a", "b"])
    rare = rare.groupBy("_row").agg(F.sum("n").alias("_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("_rare"))
    scored = encoded.drop("ids", "rest").join(recurrent_scores(encoded, model), "_row").join(rare, "_row", "left")
    missing = F.coalesce("_rare", F.lit(0.0))
    base = float(np.log10(lexicon.tokens + lexicon.words + 1))
    base_other = float(np.log10(lexicon.other_tokens + lexicon.other_words + 1))
    return scored.select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("counted") + missing - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model_score") + F.col("counted_other") + missing - F.col("n_other") * base_other).alias("score"),
    )
