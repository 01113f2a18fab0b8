"""Benchmark passages found by an FM-index over each shard of training text.

A shard is what a task has read up to 16 MB. Its symbols are the words of the test phrases; a word that no
phrase has ends a stretch, as the end of a text does. Over all stretches the task builds a suffix order, its
Burrows-Wheeler transform as a wavelet matrix, and samples of the suffix positions. All phrases are searched backwards together, one word a step, by ranks in the
wavelet matrix; occurrences are located by walking to a sampled position, and their spans merge.

A phrase is ``window`` consecutive words of an item, or the whole item if it is shorter. Phrases reach the
tasks in blocks of at most ``PHRASES`` rows, so what is sent has a bound whatever the benchmark's size; with
more blocks, the texts go through one search after another in the same stage. Nothing is shuffled.

Null texts and texts without words have no hits, items without words no phrases. Item ids are compared as
strings; rows that repeat an item count once, rows without an
item id not at all. Columns besides id and text keep their names and values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.superkmers import _cover, cut_text
from logtide.llm.words import ALNUM, bytes_of, find_words, slices, word_hashes

PHRASES = 200_000
SHARD_BYTES = 16 << 20
SAMPLE_STEP = 16


class Wavelet:
    """Ranks and symbols of a sequence, bit by bit from the highest; each level keeps counts of ones."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        level = symbols
        for bit in range(self.bits - 1, -1, -1):
            one = (level >> bit) & 1 == 1
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(len(level) - int(self.ones[-1][-1]))
            level = np.concatenate([level[~one], level[one]])
        self.begin = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before ``at``."""
        return self._down(symbol, at) - self.begin[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[at + 1] - ones[at] == 1
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones[at], at - ones[at])
        return symbol, at - self.begin[symbol]


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes, by doubling; every 0 is its own symbol, in order of place."""
    n, ends = len(sequence), np.flatnonzero(sequence == 0)
    rank = sequence.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + len(ends) + int(sequence.max()) + 2) + after
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Search over stretches of symbols 1.., each closed by 0."""

    def __init__(self, sequence: np.ndarray, largest: int):
        order = suffix_order(sequence)
        before = np.where(order > 0, sequence[order - 1], 0)
        self.wavelet = Wavelet(before, largest)
        counts = np.bincount(sequence, minlength=largest + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        sampled = (order % SAMPLE_STEP == 0) | (before == 0)
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each phrase ``words[first[p]:first[p + 1]]``, from its last word backwards."""
        left = np.diff(first)
        low, high = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        active = np.flatnonzero(left > 0)
        last = words[first[active + 1] - 1]
        low[active], high[active] = self.before[last], self.before[last + 1]
        left = left - 1
        while True:
            active = active[(low[active] < high[active]) & (left[active] > 0)]
            if not len(active):
                return low, np.maximum(low, high)
            word = words[first[active] + left[active] - 1]
            both = self.wavelet.rank(np.tile(word, 2), np.concatenate([low[active], high[active]]))
            low[active] = self.before[word] + both[: len(active)]
            high[active] = self.before[word] + both[len(active) :]
            left[active] -= 1

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, each by steps back to a sampled one."""
        out, at, steps = np.empty(len(rows), np.int64), rows.copy(), 0
        open_rows = np.arange(len(rows))
        while len(open_rows):
            here = at[open_rows]
            known = self.sampled[here + 1] > self.sampled[here]
            done = open_rows[known]
            out[done] = self.positions[self.sampled[here[known]]] + steps
            open_rows = open_rows[~known]
            symbol, rank = self.wavelet.symbol_and_rank(at[open_rows])
            at[open_rows] = self.before[symbol] + rank
            steps += 1
        return out


class Phrases:
    """One block of phrases: a vocabulary of word hashes, phrases as word numbers, and the items of each."""

    def __init__(self, rows: list[tuple[str, str]]):
        texts = sorted({text for text, _ in rows})
        place = {text: k for k, text in enumerate(texts)}
        found = find_words(pa.array(texts, pa.string()), ALNUM)
        hashes = word_hashes(found)
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        self.words, self.first = number.astype(np.int64) + 1, found.first
        self.lengths = np.diff(self.first)
        self.items = sorted({item for _, item in rows}, key=lambda i: (i is None, i or ""))
        numbered = {item: k for k, item in enumerate(self.items)}
        pairs = np.array(sorted({(place[t], numbered[i]) for t, i in rows}), np.int64).reshape(-1, 2)
        self.item_of = pairs[:, 1]
        self.item_first = np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1))
        self.likely = np.zeros(1 << 16, bool)
        self.likely[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, or 0."""
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.likely[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[place] == hashes[at]
        out[at[same]] = place[same] + 1
        return out


def _stretches(inside: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of runs of True within one text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.append(True, owner[1:] != owner[:-1])
    opens = inside & (cut | np.append(True, ~inside[:-1]))
    closes = inside & np.append(cut[1:] | ~inside[1:], True)
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


class _Shard:
    """Stretches of one shard, and the row and word each begins at."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.parts, self.rows, self.bytes = phrases, [], 0, 0
        self.count: list[np.ndarray] = []
        self.held: list[pa.RecordBatch] = []

    def add(self, part: pa.RecordBatch) -> None:
        words = find_words(part.column(0), ALNUM)
        numbers, owner = self.phrases.numbers(word_hashes(words)), words.owner()
        begin, end = _stretches(numbers > 0, owner)
        if len(begin):
            length = end - begin
            to = np.cumsum(length + 1)
            sequence = np.zeros(to[-1], np.int64)
            index = np.arange(length.sum()) + np.repeat(np.arange(len(begin)), length)
            source = np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)
            sequence[index] = numbers[source]
            self.parts.append((sequence, length, owner[begin] + self.rows, begin - words.first[owner[begin]]))
        self.count.append(np.diff(words.first))
        self.held.append(part)
        self.rows += part.num_rows
        self.bytes += len(words.data)

    def hits(self) -> tuple[np.ndarray, ...]:
        """Merged spans (row, first word, words), and the items of each row (row, item)."""
        none = np.zeros(0, np.int64)
        if not self.parts:
            return none, none, none, none, none
        sequence, length, row, word = (np.concatenate([p[k] for p in self.parts]) for k in range(4))
        phrases = self.phrases
        index = FMIndex(sequence, len(phrases.vocabulary))
        low, high = index.search(phrases.words, phrases.first)
        count = high - low
        phrase = np.repeat(np.arange(len(count)), count)
        places = index.locate(np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count))
        hit = _cover(places, phrases.lengths[phrase], len(sequence))
        stretch_at = np.cumsum(length + 1) - length - 1
        begin, end = _stretches(hit, np.zeros(len(hit), np.int8))
        own = np.searchsorted(stretch_at, begin, "right") - 1
        # a row's items, once each
        of = row[np.searchsorted(stretch_at, places, "right") - 1]
        seen = np.unique(of * len(count) + phrase)
        of, phrase = seen // len(count), seen % len(count)
        many = np.diff(phrases.item_first)[phrase]
        item = phrases.item_of[
            np.arange(many.sum()) + np.repeat(phrases.item_first[phrase] - (np.cumsum(many) - many), many)
        ]
        seen = np.unique(np.repeat(of, many) * len(phrases.items) + item)
        return row[own], word[own] + begin - stretch_at[own], end - begin, seen // len(phrases.items), seen % len(phrases.items)


def _lists(row: np.ndarray, values: pa.Array, rows: int, before: pa.Array) -> pa.Array:
    """Values by row as lists, after those that ``before`` has."""
    fresh = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values)
    if not len(before.values):
        return fresh
    # a further block of phrases: older entries first
    old_at, new_at = before.offsets.to_numpy(), fresh.offsets.to_numpy()
    both = pa.concat_arrays([before.values, fresh.values])
    take = [
        np.concatenate([np.arange(old_at[t], old_at[t + 1]), len(before.values) + np.arange(new_at[t], new_at[t + 1])])
        for t in range(rows)
    ]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in take])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), both.take(pa.array(np.concatenate(take))))


SPAN = pa.struct([("start", pa.int32()), ("words", pa.int32())])


def _search(rows: list[tuple[str, str]]):
    phrases = Phrases(rows)

    def finish(shard: _Shard) -> pa.RecordBatch:
        table = pa.Table.from_batches(shard.held).combine_chunks().to_batches()[0]
        row, start, words, of, item = shard.hits()
        spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(words, pa.int32())], fields=list(SPAN))
        items = pa.array(np.array(phrases.items, object)[item], pa.string())
        columns = [
            table.column(0),
            pa.array(np.concatenate(shard.count), pa.int64()),
            _lists(row, spans, table.num_rows, table.column(2)),
            _lists(of, items, table.num_rows, table.column(3)),
            *table.columns[4:],
        ]
        return pa.RecordBatch.from_arrays(columns, table.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(phrases)
        for part in slices(batches, "_text"):
            shard.add(part)
            if shard.bytes >= SHARD_BYTES:
                yield finish(shard)
                shard = _Shard(phrases)
        if shard.held:
            yield finish(shard)

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            words = find_words(part.column(1), ALNUM)
            text, item = [], []
            for t, name in enumerate(part.column(0).to_pylist()):
                a, b = int(words.first[t]), int(words.first[t + 1])
                own = [words.data[x:y].tobytes().decode() for x, y in zip(words.start[a:b], words.end[a:b])]
                found = {" ".join(own[k : k + window]) for k in range(max(1, len(own) - window + 1))} if own else ()
                text += found
                item += [name] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(item, pa.string())], ["phrase", "item"])

    return run


def phrase_blocks(items: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """Distinct (phrase, item) rows, at most ``PHRASES`` at a time; items without an id are one, under null."""
    source = items.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = source.mapInArrow(_windows(window), "phrase string, item string").distinct()
    block: list[tuple[str, str]] = []
    for row in rows.sort("phrase", "item").toLocalIterator():
        block.append((row["phrase"], row["item"]))
        if len(block) == PHRASES:
            yield block
            block = []
    if block:
        yield block


def find_passages(
    docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    cut: bool = False,
) -> DataFrame:
    """The columns of ``docs`` as c0, c1, … in order, after ``_text, n_words, spans, items``.

    Spans may touch or overlap if there was more than one block of phrases. With ``cut``, they are cut out of the
    text, by the Python step that ends the search.
    """
    empty: list[Column] = [
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:int,words:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    ]
    rest = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_col]
    out = docs.select(F.col(text_col).cast("string").alias("_text"), *empty, *rest)
    blocks, kind = phrase_blocks(items, window, item_id, item_text), out.schema
    block = next(blocks, None)
    if block is None:
        return out.mapInArrow(_count_words, kind)
    while block is not None:
        search, block = _search(block), next(blocks, None)
        out = out.mapInArrow(_then_cut(search) if cut and block is None else search, kind)
    return out


def _then_cut(search):
    """Search and cut in one Python step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _cut_spans(search(batches))

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """No phrases at all: only the number of words."""
    for part in slices(batches, "_text"):
        counts = np.diff(find_words(part.column(0), ALNUM).first)
        yield part.set_column(1, "n_words", pa.array(counts, pa.int64()))


def _words_hit() -> Column:
    """Words in any span; spans of different blocks of phrases may overlap."""
    places = F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["words"] - 1))
    return F.size(F.array_distinct(F.flatten(places))).cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for each row."""
    found = find_passages(docs.select(id_col, text_col), items, window, text_col)
    names = F.array_sort(F.array_distinct("items"))
    return found.select(
        F.col("c0").alias(id_col),
        "n_words",
        _words_hit().alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "_text"):
        lists = part.column(2)
        at, spans = lists.offsets.to_numpy(), lists.values
        hit_rows = np.flatnonzero(np.diff(at))
        texts = part.column(0).to_pylist()
        if len(hit_rows):
            start, count = (spans.field(k).to_numpy(False).astype(np.int64) for k in ("start", "words"))
            few = part.column(0).take(pa.array(hit_rows))
            words = find_words(few, ALNUM)
            raw, raw_at = bytes_of(few)
            for k, t in enumerate(hit_rows):
                a, b = int(words.first[k]), int(words.first[k + 1])
                own = slice(at[t], at[t + 1])
                gone = _cover(start[own], count[own], b - a)
                texts[t] = cut_text(raw[raw_at[k] : raw_at[k + 1]], words.start[a:b] - raw_at[k], gone)
        yield part.set_column(0, "_text", pa.array(texts, pa.string()))


def remove_passages(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with benchmark passages cut out of the text, and ``n_hit`` words cut."""
    cut = find_passages(docs, items, window, text_col, cut=True)
    place = {c: F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns) if c not in (text_col, "n_hit")}
    place[text_col] = F.col("_text").alias(text_col)
    return cut.select(*[place[c] for c in docs.columns if c in place], _words_hit().alias("n_hit"))
