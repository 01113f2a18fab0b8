"""Exact token counts, with huge texts encoded in overlapping chunks.

A text of more than ``chunk`` characters is encoded chunk by chunk with offsets. Neighbouring chunks overlap;
they are spliced where both have a token boundary at a place that is stable for certain: an ASCII white-space
character after a character that is no white space. Byte-level pre-tokenizers always split there, and what they
do to the right of it doesn't depend on what stands to the left; added tokens have no white space inside. If an
overlap has no such place, it is widened, up to the whole stretch that is still open, and then the chunk itself grows.

Shorter texts are split at the same places into pieces, which are found and named by array operations on the UTF-8 bytes.
Each distinct piece is encoded once for as long as it stays in a worker's memo of a fixed number of entries, of which the
least used half goes when it is full.

Null is counted as empty: 0 bytes, 0 tokens. Rows that repeat an id are counted each. Columns besides id and
text are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import WHITE, U, Words, bytes_of, distinct, gather, give_back, slices, words_in

CHUNK = 32_768
#: Where texts up to a million characters may be split into pieces too, which is faster; the counts are the same.
WHOLE = 1 << 20
OVERLAP = 256
MEMO_ENTRIES = 400_000
#: White space beyond ASCII's usual, after which a split is not certain, as UTF-8 bytes read as one number.
ODD_1 = np.arange(0x1C, 0x20)
ODD_2 = np.array([0xC285, 0xC2A0])
ODD_3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
STABLE = re.compile(r"(?<=\S)[ \t\n\x0b\x0c\r]")


def find_pieces(column: pa.Array) -> tuple[Words, np.ndarray]:
    """Pieces of all texts, each white space and then other characters, or a text's last white space; and the text of each."""
    data, offsets = bytes_of(column)
    ends = words_in(data, offsets, WHITE).end
    last = data[ends - 1].astype(np.int64)
    two = (data[np.maximum(ends - 2, 0)].astype(np.int64) << 8) | last
    three = (data[np.maximum(ends - 3, 0)].astype(np.int64) << 16) | two
    odd = np.isin(last, ODD_1) | np.isin(two, ODD_2) | np.isin(three, ODD_3)
    cuts = np.sort(np.concatenate([offsets, ends[~odd]]), kind="stable")  # two sorted runs
    cuts = cuts[np.concatenate([[True], cuts[1:] > cuts[:-1]])]
    start, end = cuts[:-1], cuts[1:]
    owner = np.searchsorted(offsets, start, "right") - 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets), owner


class Counter:
    """A tokenizer of the ``tokenizers`` library and the counts of pieces it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.one = self.two = np.zeros(0, U)  # names of known pieces, their token counts, and how often they came up
        self.tokens = self.used = np.zeros(0, np.int64)

    def counts(self, texts: list[str] | pa.Array, chunk: int = CHUNK) -> np.ndarray:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        long = pc.greater(pc.utf8_length(column), chunk).to_numpy(zero_copy_only=False)
        total = np.zeros(len(column), np.int64)
        total[long] = [self.spliced(column[int(k)].as_py(), chunk) for k in np.flatnonzero(long)]
        short = column.filter(pa.array(~long)) if long.any() else column
        pieces, owner = find_pieces(short)
        total[~long] = np.bincount(owner, self._sizes(pieces), len(short)).astype(np.int64)
        return total

    def _known(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The memo's entry of each name, or -1."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)

    def _sizes(self, pieces: Words) -> np.ndarray:
        """Tokens of each piece."""
        one, two, index, inverse = distinct(pieces)
        at = self._known(one, two)
        known, fresh = at >= 0, np.flatnonzero(at < 0)
        sizes, used = np.zeros(len(one), np.int64), np.bincount(inverse, minlength=len(one))
        sizes[known] = self.tokens[at[known]]
        self.used[at[known]] += used[known]
        for begin in range(0, len(fresh), 10_000):
            part = fresh[begin : begin + 10_000]
            data, offsets = gather(pieces.data, pieces.start[index[part]], pieces.end[index[part]])
            buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
            strings = pa.Array.from_buffers(pa.large_string(), len(part), buffers).to_pylist()
            sizes[part] = [len(e) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        if len(fresh):
            self._remember(one[fresh], two[fresh], sizes[fresh], used[fresh])
        return sizes[inverse]

    def _remember(self, *fresh: np.ndarray) -> None:
        held = [self.one, self.two, self.tokens, self.used]
        if len(self.one) + len(fresh[0]) > MEMO_ENTRIES:
            best = np.sort(np.argsort(-self.used, kind="stable")[: MEMO_ENTRIES // 2])
            held = [x[best] for x in held]
            held[3] = held[3] // 2
        joined = [np.concatenate(x) for x in zip(held, fresh)]
        order = np.argsort(joined[0], kind="stable")
        self.one, self.two, self.tokens, self.used = (x[order] for x in joined)

    def _encode(self, text: str, begin: int, end: int) -> np.ndarray:
        """Token offsets in the whole text, begins and ends."""
        found = self.tokenizer.encode(text[begin:end], add_special_tokens=False).offsets
        return np.array(found, np.int64).reshape(-1, 2) + begin

    def spliced(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of the whole text, from overlapping chunks."""
        total, begin, end = 0, 0, min(chunk, len(text))
        own = self._encode(text, begin, end)
        while end < len(text):
            width, place = min(overlap, chunk // 2), -1
            while True:
                start = max(begin, end - width)
                ahead_end = min(start + chunk + width, len(text))
                # only overlaps that hold a stable place are worth encoding
                marks = [m.start() for m in STABLE.finditer(text, max(start, 1), end) if m.start() > begin]
                if marks:
                    ahead = self._encode(text, start, ahead_end)
                    place = self._common(own, ahead, marks)
                    if place >= 0:
                        break
                if start == begin:
                    break
                width *= 2
            if place < 0:  # no stable place in all that is open: the chunk grows
                end = min(len(text), begin + 2 * (end - begin))
                own = self._encode(text, begin, end)
                continue
            total += int((own[:, 1] <= place).sum())
            own = ahead[ahead[:, 1] > place]
            begin, end = place, ahead_end
        return total + len(own)

    @staticmethod
    def _common(left: np.ndarray, right: np.ndarray, marks: list[int]) -> int:
        """The last stable place that no token of either side straddles and where both sides have a token after it, or -1."""
        for place in reversed(marks):
            if all((side[:, 1] > place).any() and not ((side[:, 0] < place) & (place < side[:, 1])).any() for side in (left, right)):
                return place
        return -1


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter for each worker and vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file, looked up where it is used."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(
    docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
    keep: bool = True,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row; ``name`` is a byte-level vocabulary file's name or path.

    A worker keeps the vocabulary and its memo for its next task, unless ``keep`` is false: where other steps follow in the
    same workers, their memory counts for more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = name if os.path.isabs(name) else vocabulary(name)
        count = counter(path).counts
        for part in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(count(part.column(2), chunk))], ["_id", "n_bytes", "n_tokens"]
            )
        if not keep:
            del count
            _COUNTERS.pop(path, None)
            give_back()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = source.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
