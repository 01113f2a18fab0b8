"""Repeated passages by super-k-mers: exact counting of every window of words.

Of each window of ``window`` words, the least three-word group (in a fixed random order that puts
short, common groups last) is its minimiser. Consecutive windows with the same minimiser travel as one
packed string to the minimiser's bucket; equal windows have equal minimisers, so they meet there. In
the bucket the windows are sorted, and the first place of each is found.

* Strings that a map task has seen before do not travel: an earlier place for all their windows is known
  already. So a passage in a third of all documents sends one string for each map task.
* Strings for one bucket leave a map task as one compressed block.
* The number of buckets follows the bytes of the input, so a bucket stays about as large as ``bucket_bytes``.
* Only removed ranges come back, and meet the texts by id.

Strings and windows are compared by 128 bits of hash. Null and empty texts have no windows. Rows that repeat an id and
a text are one text at one place: neither row is earlier, and both get the same result. Rows without an id
come before all others. Columns besides id and text keep their names and values.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import U, WHITE, bytes_of, chain, find_words, gather, give_back, mix, runs, slices, whole_id, word_hashes, words_in
from logtide.scratch import materialize

GROUP = 3
SHORT_BYTES = 12
TASK_BYTES = 10 << 20
NO_ID = -(1 << 63)
LEVEL = 6


def _least(values: np.ndarray, first: np.ndarray, size: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``size`` words: its least group value, first word and text."""
    start, owner = runs(first, size)
    if not len(start):  # a slice of short texts may hold fewer groups than the neighbours below
        return values[:0], start, owner
    span, width = size - group + 1, 1
    least = values.copy()
    while 2 * width <= span:  # least of 2, 4, 8 … neighbours
        least[: len(least) - width] = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    return np.minimum(least[start], least[start + span - width]), start, owner


def super_kmers(texts: pa.Array, window: int, group: int = GROUP):
    """Words, and for each super-k-mer its minimiser, first word, number of windows and text."""
    words = find_words(texts, lower=False)
    hashes = word_hashes(words)
    values = chain(hashes, group)
    if len(values):
        # bytes of the words alone: white space between them must not matter
        length = np.concatenate([[0], np.cumsum(words.end - words.start)])
        short = length[group:] - length[:-group] < SHORT_BYTES
        values = (values >> U(1)) | (short.astype(U) << U(63))
    least, start, owner = _least(values, words.first, window, group)
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(least)))
    return words, hashes, least[at], start[at], count, owner[at]


def _pack(**columns: np.ndarray) -> bytes:
    """Columns of one block: lengths, then the bytes, compressed. Rows in text order compress best."""
    parts = [np.ascontiguousarray(c).tobytes() for c in columns.values()]
    return zstandard.ZstdCompressor(level=LEVEL).compress(struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts))


def _unpack(block: bytes, *kinds) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    lengths = struct.unpack_from(f"<{len(kinds)}q", data)
    at, out = 8 * len(kinds), []
    for kind, n in zip(kinds, lengths):
        out.append(np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


class _Outbox:
    """Super-k-mers that a task has gathered, leaving as one block for each bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.bytes = buckets, [], 0

    def add(self, minimiser, one, two, ids, marks, start, words, data, offsets) -> None:
        self.held.append((minimiser, one, two, ids, marks, start, words, data, offsets))
        self.bytes += len(data)

    def flush(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, strings, ranges): strings that are new, by bucket, and ranges known to be repeats."""
        if not self.held:
            return
        minimiser, one, two, ids, marks, start, words = (np.concatenate([h[k] for h in self.held]) for k in range(7))
        length = np.concatenate([np.diff(h[8]) for h in self.held])
        data = np.concatenate([h[7] for h in self.held])
        end = np.cumsum(length)
        begin = end - length
        self.held, self.bytes = [], 0
        order = np.lexsort((start, ids, two, one))
        head = np.ones(len(order), bool)
        head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        # an equal place is the same text read twice: no repeat of itself
        lead = np.flatnonzero(head)[np.cumsum(head) - 1]
        same = (ids[order] == ids[order][lead]) & (start[order] == start[order][lead]) & ~head
        known = order[~head & ~same]
        if len(known):
            yield -1, b"", _pack(ids=ids[known], marks=marks[known], start=start[known], words=words[known])
        kept = order[head]
        # rows of one text read twice under different marks still need their ranges: they travel too
        kept = np.sort(np.concatenate([kept, order[same & (marks[order] != marks[order][lead])]]))
        bucket = (mix(minimiser[kept]) % U(self.buckets)).astype(np.int64)
        kept = kept[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(edge, np.append(edge[1:], len(kept))):
            rows = kept[a:b]
            text, _ = gather(data, begin[rows], end[rows])
            yield int(bucket[a]), _pack(
                ids=ids[rows], marks=marks[rows], start=start[rows], length=length[rows].astype(np.int32), text=text
            ), b""


def _send(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(buckets)

        def blocks():
            rows = list(box.flush())
            spread = [b if b >= 0 else k for k, (b, _, _) in enumerate(rows)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spread, pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    ["bucket", "strings", "ranges"],
                )

        for part in slices(batches, "_text"):
            ids = part.column(0).fill_null(NO_ID).to_numpy(False)
            marks = part.column(1).to_numpy(False)
            words, hashes, minimiser, start, count, owner = super_kmers(part.column(2), window)
            if not len(start):
                continue
            last = start + count + window - 2  # last word
            # one space between words, whatever stood there
            data, offsets = _joined(words)
            begin, end = offsets[start], offsets[last + 1] - 1
            text, at = gather(data, begin, end)
            names = (_range_names(hashes, start, last + 1, salt) for salt in (0, 1))
            box.add(minimiser, *names, ids[owner], marks[owner], (start - words.first[owner]).astype(np.int32), (last + 1 - start).astype(np.int32), text, at)
            if box.bytes >= TASK_BYTES:
                yield from blocks()
        yield from blocks()

    return run


def _joined(words) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space after each, and where each starts (one more entry than words)."""
    length = words.end - words.start + 1
    offsets = np.concatenate([[0], np.cumsum(length)])
    index = np.arange(offsets[-1]) + np.repeat(words.start - offsets[:-1], length)
    np.minimum(index, max(len(words.data) - 1, 0), out=index)
    data = words.data[index]
    data[offsets[1:] - 1] = 32
    return data, offsets


_FACTORS: dict[int, np.ndarray] = {}


def _range_names(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit name of each range of words, from prefix sums of hash times a power of its place."""
    n = len(hashes) + 1
    odd = 0x9E3779B97F4A7C15 + 2 * salt * 0x1234567
    key = salt
    with np.errstate(over="ignore"):
        if key not in _FACTORS or _FACTORS[key].shape[1] < n:
            up, down = np.full(n, odd % (1 << 64), U), np.full(n, pow(odd, -1, 1 << 64), U)
            up[0] = down[0] = 1
            _FACTORS[key] = np.stack([np.cumprod(up), np.cumprod(down)])
        up, down = _FACTORS[key]
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes + U(salt)) * up[: n - 1])])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


def repeats_in_bucket(ids, marks, start, length, text, window: int):
    """Ranges (id, mark, first word, words) that windows with an earlier equal window cover."""
    offsets = np.concatenate([[0], np.cumsum(length.astype(np.int64))])
    words = words_in(text, offsets, WHITE)
    hashes = word_hashes(words)
    first, owner = runs(words.first, window)
    if not len(first):
        return ids[:0], marks[:0], start[:0], start[:0]
    one, two = _range_names(hashes, first, first + window), _range_names(hashes, first, first + window, 1)
    place = start[owner].astype(np.int64) + first - words.first[owner]
    # equal windows stand together, the earliest place first
    rank = np.empty(len(ids), np.int64)
    by_id = np.argsort(ids, kind="stable")
    rank[by_id] = np.cumsum(np.append(0, ids[by_id][1:] != ids[by_id][:-1]))
    order = np.lexsort((place, rank[owner], two, one))
    head = np.ones(len(order), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    earlier = (rank[owner[order]] != rank[owner[order[lead]]]) | (place[order] != place[order[lead]])
    hit = np.zeros(len(order), bool)
    hit[order[earlier]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return ids[:0], marks[:0], start[:0], start[:0]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]))
    head_at, n = at[new], np.diff(np.append(np.flatnonzero(new), len(at)))
    own = owner[head_at]
    return ids[own], marks[own], place[head_at].astype(np.int32), (n + window - 1).astype(np.int32)


def _count(window: int):
    """All blocks of one bucket after another; a bucket's strings are sorted together."""

    def found(held: list[bytes]):
        columns = [_unpack(b, np.int64, np.int32, np.int32, np.int32, np.uint8) for b in held]
        return repeats_in_bucket(*(np.concatenate([c[k] for c in columns]) for k in range(5)), window)

    def ranges(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["_id", "_mark", "start", "words"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for bucket, strings, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if known := known.as_py():
                    yield ranges(_unpack(known, np.int64, np.int32, np.int32, np.int32))
                if bucket != current:
                    if held:
                        yield ranges(found(held))
                    current, held = bucket, []
                if strings := strings.as_py():
                    held.append(strings)
        if held:
            yield ranges(found(held))
        _FACTORS.clear()  # a worker lives on after its task
        give_back()

    return run


RANGES = "_id long, _mark int, start int, words int"


def repeated_ranges(texts: DataFrame, window: int, bucket_bytes: int) -> DataFrame:
    """Ranges of words to remove, of ``texts(_id, _mark, _text)``."""
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    sent = texts.mapInArrow(_send(window, buckets), "bucket int, strings binary, ranges binary")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")  # a partition takes its buckets in turn
    return dealt.mapInArrow(_count(window), RANGES)


def _cover(start: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words some range covers."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, np.minimum(start + count, n), -1)
    return np.cumsum(steps[:n]) > 0


def _cut(digest: bool):
    """Counts, and the sha256 of the kept words or the text without the removed stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            words = find_words(part.column(0), lower=False)
            lists = part.column(1)
            spans, at = lists.values, lists.offsets.to_numpy()
            span_start = spans.field("start").to_numpy(False) if len(spans) else np.zeros(0, np.int32)
            span_words = spans.field("words").to_numpy(False) if len(spans) else np.zeros(0, np.int32)
            valid = lists.is_valid().to_numpy(False)
            total, removed, value = [], [], []
            joined, joined_at = _joined(words)
            raw, raw_at = bytes_of(part.column(0))
            for t in range(part.num_rows):
                a, b = int(words.first[t]), int(words.first[t + 1])
                own = slice(at[t], at[t + 1]) if valid[t] else slice(0, 0)
                gone = _cover(span_start[own].astype(np.int64), span_words[own].astype(np.int64), b - a)
                total.append(b - a)
                removed.append(int(gone.sum()))
                if digest:
                    if removed[-1]:
                        kept = np.flatnonzero(~gone) + a
                        text, _ = gather(joined, joined_at[kept], joined_at[kept + 1])
                    else:
                        text = joined[joined_at[a] : joined_at[b]]
                    value.append(hashlib.sha256(text[:-1].tobytes()).hexdigest())
                else:
                    value.append(cut_text(raw[raw_at[t] : raw_at[t + 1]], words.start[a:b] - raw_at[t], gone))
            yield pa.RecordBatch.from_arrays(
                [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(value, pa.string()), *part.columns[2:]],
                ["n_words", "n_removed", "value", *part.schema.names[2:]],
            )

    return run


def cut_text(raw: np.ndarray, start: np.ndarray, gone: np.ndarray) -> str:
    """The text without its ``gone`` words; white space after a removed word goes with it."""
    if not gone.any():
        return raw.tobytes().decode()
    steps = np.append(start, len(raw))
    keep = np.ones(len(raw), bool)
    for a, b in zip(steps[:-1][gone], steps[1:][gone]):
        keep[a:b] = False
    return raw[keep].tobytes().decode().strip(" \t\n\x0b\x0c\r")


def _with_ranges(docs: DataFrame, window: int, id_col: str, text_col: str, bucket_bytes: int) -> DataFrame:
    """Texts with their ranges; the mark tells rows apart that share an id."""
    texts = docs.select(
        whole_id(docs, id_col).alias("_id"), F.hash(F.col(text_col)).alias("_mark"), F.col(text_col).cast("string").alias("_text")
    )
    found = materialize(repeated_ranges(texts, window, bucket_bytes), "ranges")
    return found.groupBy("_id", "_mark").agg(F.collect_list(F.struct("start", "words")).alias("_spans"))


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    bucket_bytes: int = 3 << 20,
) -> DataFrame:
    """Every word that a window with an earlier equal window covers goes; earlier is a smaller id, then a smaller place.

    With ``digest``: (id, n_words, n_removed, kept_sha256). Else: the rows of ``docs`` with the cut text, and
    ``n_words`` and ``n_removed`` (columns of ``docs`` with these names are replaced).
    """
    spans = _with_ranges(docs, window, id_col, text_col, bucket_bytes)
    own = F.coalesce(whole_id(docs, id_col), F.lit(NO_ID))
    rest = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed")] if not digest else [id_col]
    left = docs.select(
        F.col(text_col).cast("string").alias("_text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)],
        own.alias("_id"), F.hash(F.col(text_col)).alias("_mark"),
    )
    joined = left.join(spans, ["_id", "_mark"], "left").select("_text", "_spans", *[f"c{k}" for k in range(len(rest))])
    kinds = ", ".join(["n_words long, n_removed long, value string", *[f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(rest)]])
    cut = joined.mapInArrow(_cut(digest), kinds)
    names = {f"c{k}": c for k, c in enumerate(rest)}
    if digest:
        return cut.select(F.col("c0").alias(id_col), "n_words", "n_removed", F.col("value").alias("kept_sha256"))
    place = {c: F.col(k).alias(c) for k, c in names.items()} | {text_col: F.col("value").alias(text_col)}
    return cut.select(*[place[c] for c in docs.columns if c in place], "n_words", "n_removed")
