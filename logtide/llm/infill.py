"""Fill-in-the-middle texts from seekable compressed frames.

A text is stored as independent zstandard frames with the number of code points up to the end of each. A range of code
points is then a few whole frames, moved as they are, and at most two frames that a cut goes through, which alone
are decompressed and compressed anew. The transformed text is stored the same way; digests read its frames one
after another, and the original is rebuilt from it by searching its frames for the marks.

Cuts and forms follow from a hash of the id, so they hang neither on the partitioning nor on other rows. Null and empty
texts have no frames and the form ``plain``. Rows that repeat an id are cut each, at places that depend on their own
lengths. A null id counts as an empty one. A very long text is held in compressed form as a whole, and decompressed
frame by frame. Columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import slices

FRAME_UNITS = 16_384
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
FRAMES = "array<struct<end: bigint, blob: binary>>"
ARROW_FRAMES = pa.list_(pa.struct([("end", pa.int64()), ("blob", pa.binary())]))


class _Codec:
    """One compressor and one decompressor for each worker."""

    _held: _Codec | None = None

    def __init__(self):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.unpack = zstandard.ZstdDecompressor().decompress

    @classmethod
    def get(cls) -> _Codec:
        cls._held = cls._held or cls()
        return cls._held


@dataclass
class Frames:
    """A text as compressed frames; ``ends[k]`` code points lie before the end of frame k."""

    ends: list[int] = field(default_factory=list)
    blobs: list[bytes] = field(default_factory=list)

    @classmethod
    def of(cls, text: str, units: int = FRAME_UNITS) -> Frames:
        out = cls()
        for at in range(0, len(text), units):
            out.add(text[at : at + units])
        return out

    @classmethod
    def stored(cls, rows: list[dict] | None) -> Frames:
        return cls([r["end"] for r in rows or ()], [r["blob"] for r in rows or ()])

    def rows(self) -> list[dict]:
        return [{"end": e, "blob": b} for e, b in zip(self.ends, self.blobs)]

    @property
    def units(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add(self, text: str) -> None:
        if text:
            self._append(len(text), _Codec.get().pack(text.encode()))

    def _append(self, units: int, blob: bytes) -> None:
        self.ends.append(self.units + units)
        self.blobs.append(blob)

    def text(self, k: int) -> str:
        return _Codec.get().unpack(self.blobs[k]).decode()

    def parts(self, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Frames that hold code points begin..end, with the range within each."""
        k = int(np.searchsorted(self.ends, begin, "right"))
        while k < len(self.ends) and (low := self.ends[k - 1] if k else 0) < end:
            yield k, max(begin - low, 0), min(end, self.ends[k]) - low
            k += 1

    def move(self, other: Frames, begin: int, end: int) -> None:
        """Append a range of another text: whole frames as they are, cut ones anew."""
        for k, a, b in other.parts(begin, end):
            units = other.ends[k] - (other.ends[k - 1] if k else 0)
            if b - a == units:
                self._append(units, other.blobs[k])
            else:
                self.add(other.text(k)[a:b])

    def read(self, begin: int = 0, end: int | None = None) -> Iterator[str]:
        """The texts of a range, frame by frame."""
        for k, a, b in self.parts(begin, self.units if end is None else end):
            text = self.text(k)
            yield text[a:b] if b - a < len(text) else text

    def find(self, mark: str, begin: int = 0) -> int:
        """Where ``mark`` first stands at or after ``begin``, also across frames; -1 if nowhere."""
        kept, at = "", begin
        for text in self.read(begin):
            joined = kept + text
            if (place := joined.find(mark)) >= 0:
                return at - len(kept) + place
            at += len(text)
            kept = joined[len(joined) - len(mark) + 1 :] if len(joined) >= len(mark) else joined
        return -1


def digest(parts: Iterator[str]) -> str:
    """Lower-case hex SHA-256 of the UTF-8 bytes of a stream of texts."""
    out = hashlib.sha256()
    for part in parts:
        out.update(part.encode())
    return out.hexdigest()


def transform(source: Frames, form: str, low: int, high: int) -> Frames:
    """The output's frames: the text itself, or its three parts in the order of ``form``, each after its mark."""
    if form == "plain":
        return source
    prefix, suffix, middle = (PREFIX, 0, low), (SUFFIX, high, source.units), (MIDDLE, low, high)
    out = Frames()
    for mark, begin, end in (suffix, prefix, middle) if form == "spm" else (prefix, suffix, middle):
        out.add(mark)
        out.move(source, begin, end)
    return out


def restore(output: Frames, form: str) -> Iterator[str]:
    """The original text, frame by frame, from the output and its form alone."""
    if form == "plain":
        return output.read()
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    at, begin = {}, 0
    for mark in order:
        at[mark] = begin = output.find(mark, begin)
        begin += len(mark)
    ends = dict(zip(order, [at[order[1]], at[order[2]], output.units]))
    return chain.from_iterable(output.read(at[m] + len(m), ends[m]) for m in (PREFIX, MIDDLE, SUFFIX))


def store_frames(docs: DataFrame, frame_units: int = FRAME_UNITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, marked, frames)`` for each row: code points, whether a mark stands in the text, and its frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            frames = [Frames.of(t, frame_units).rows() for t in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(frames, ARROW_FRAMES)], ["_id", "n", "marked", "frames"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    source = docs.select(F.col(id_col).alias("_id"), F.length(text).cast("long").alias("n"), marked.alias("marked"), text.alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, n long, marked boolean, frames {FRAMES}").withColumnRenamed("_id", id_col)


def infill_plan(stored: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, id_col: str = "doc_id") -> DataFrame:
    """The stored rows with ``form`` and the two cuts, ``low`` and ``high``, from a hash of the id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring("_key", 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4))
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= plain_from)
    form = F.when(plain, "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm")
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    return stored.withColumn("_key", key).select(
        id_col, "n", form.alias("form"), F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), "frames"
    )


def infill(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, frames)``: the frames are those of the transformed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            rows = zip(*(part.column(k).to_pylist() for k in range(2, 6)))
            made = [transform(Frames.stored(f), form, low, high).rows() for form, low, high, f in rows]
            yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(made, ARROW_FRAMES)], ["_id", "n", "form", "low", "high", "frames"])

    kind = plan.schema[id_col].dataType.simpleString()
    source = plan.select(F.col(id_col).alias("_id"), "n", "form", "low", "high", "frames")
    made = source.mapInArrow(run, f"_id {kind}, n long, form string, low long, high long, frames {FRAMES}")
    cut = F.col("form") != "plain"
    return made.select(
        F.col("_id").alias(id_col), "n", "form",
        F.when(cut, F.col("low")).alias("prefix_chars"), F.when(cut, F.col("high") - F.col("low")).alias("middle_chars"), "frames",
    )


def small(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: frames of long texts are made into Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def digests(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of :func:`infill` with digests of the output and of the text rebuilt from it, instead of frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            held = [(form, Frames.stored(f)) for form, f in zip(part.column(2).to_pylist(), part.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:5],
                    pa.array([digest(f.read()) for _, f in held], pa.string()),
                    pa.array([digest(restore(f, form)) for form, f in held], pa.string()),
                ],
                names,
            )

    kind = made.schema[id_col].dataType.simpleString()
    kinds = f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    names = [k.split()[0] for k in kinds.split(", ")]
    source = made.select(F.col(id_col).alias("_id"), "n", "form", "prefix_chars", "middle_chars", "frames")
    return source.mapInArrow(run, kinds).withColumnRenamed("_id", id_col)


def texts(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, text)``: the whole texts of rows with ``frames``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            whole = ["".join(Frames.stored(f).read()) for f in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.string())], ["_id", "text"])

    kind = made.schema[id_col].dataType.simpleString()
    return made.select(F.col(id_col).alias("_id"), "frames").mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)
