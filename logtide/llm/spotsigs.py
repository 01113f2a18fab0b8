"""Fingerprints by spot signatures (Theobald, Siddharth and Paepcke, 2008).

A spot is a common word (the anchor) and the chain of the next ``chain`` content words after it. A text's
fingerprint is its set of spots, as 32-bit hashes in order, in base64. Where no common word has come for ``FAR`` words,
every word is an anchor until the next one. A text without any full chain has the chains of
all its words instead, a text with fewer words than that its words as a whole, and one without words its
bytes; so only the empty text has an empty fingerprint, and equal texts have equal ones.

Fingerprints are compared by Jaccard likeness. Sets fall into partitions by length such that a pair of at least
``least`` likeness is in the same or in neighbouring partitions; other pairs are pruned without a look at their
entries, as are pairs whose sizes alone rule the likeness out. With ``least`` = 0 nothing is pruned.

``edited_neighbours`` compares each text with an edited one and with the next by id. Texts are sorted by id in
buckets whose boundaries come from the ids alone; the first text of a bucket is also sent to the bucket
before, so texts move once and no bucket waits for another.

``near_matches`` finds all pairs of at least ``least`` likeness, wherever they stand. Equal sets are one. A set is sent to
the cells (spot, partition) of its rarest spots only, as many as any pair of that likeness must share one of, and meets the
sets of its own and the next partition there. Pairs whose sizes allow it are compared in full and linked into
classes. A cell is compared pair by pair, so its cost is quadratic in the different sets that share a rare spot.

Null texts are empty. Of rows with one id, the order is by a hash of the text. Rows without an id come first.
Columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import ALNUM, U, bytes_of, chain as chained, find_words, slices, whole_id, word_hashes
from logtide.operators.components import connected_components
from logtide.scratch import materialize

CHAIN = 2
FAR = 8
MOST_BUCKETS = 50_000
NO_ID = -(1 << 63)

#: Common words of English, German, French and Spanish.
ANCHORS = """
the of and to in a is that it was for on are with as be this by from or an at which not have
der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er hat
le la les de des et un une du en est que qui dans pour par sur pas au avec ce il plus ne se
el los las del y que en con por una para es al lo como su no se más o
""".split()


def _anchor_hashes() -> np.ndarray:
    words = find_words(pa.array([" ".join(ANCHORS)]), ALNUM)
    return np.unique(word_hashes(words))


def spot_sets(texts: pa.Array, size: int = CHAIN) -> list[np.ndarray]:
    """The spots of each text: distinct 32-bit hashes in order."""
    words = find_words(texts, ALNUM)
    hashes = word_hashes(words)
    anchors = _anchor_hashes()
    place = np.minimum(np.searchsorted(anchors, hashes), len(anchors) - 1)
    is_anchor = anchors[place] == hashes if len(hashes) else np.zeros(0, bool)
    content = np.flatnonzero(~is_anchor)
    owner, number = words.owner(), np.arange(len(hashes))
    last = np.maximum(np.maximum.accumulate(np.where(is_anchor, number, -1)), words.first[owner] - 1) if len(number) else number
    anchor = np.flatnonzero(is_anchor | (number - last > FAR))
    after = np.searchsorted(content, anchor, "right")  # the next content word of each anchor
    fits = after + size <= len(content)
    anchor, after = anchor[fits], after[fits]
    if len(anchor):
        fits = owner[content[after + size - 1]] == owner[anchor]
        anchor, after = anchor[fits], after[fits]
    parts = chained(np.concatenate([hashes[content], np.zeros(size, U)]), size) if len(content) else np.zeros(1, U)
    with np.errstate(over="ignore"):
        spots = chained(np.column_stack([hashes[anchor], parts[after]]).ravel(), 2)[::2] if len(anchor) else np.zeros(0, U)
    first = np.searchsorted(owner[anchor], np.arange(len(words.first)))
    plain = chained(hashes, size + 1)
    raw, at = bytes_of(texts)
    out = []
    for t in range(len(words.first) - 1):
        a, b = int(words.first[t]), int(words.first[t + 1])
        own = spots[first[t] : first[t + 1]]
        if not len(own):
            if b - a > size:
                own = plain[a : b - size]
            elif b > a:
                own = chained(hashes[a:b], b - a)
            elif at[t + 1] > at[t]:
                own = np.frombuffer(hashlib.sha256(raw[at[t] : at[t + 1]].tobytes()).digest()[:8], U)
        out.append(np.unique((own >> U(32)).astype(np.uint32)))
    return out


def fingerprint(spots: np.ndarray) -> str:
    return base64.b64encode(spots.tobytes()).decode()


def length_partition(size: int, least: float) -> int:
    """Number of the partition of sets of this size: sizes that far apart cannot reach ``least``."""
    if size == 0:
        return -2
    return 0 if least <= 0 else int(math.log(size) / -math.log(least) + 1e-9) if least < 1 else size


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two ordered sets; 0 for pairs that cannot reach ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if abs(length_partition(len(a), least) - length_partition(len(b), least)) > 1 or len(small) < least * len(large):
        return 0.0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return shared / (len(a) + len(b) - shared)


def _edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the next text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compare(size: int, least: float):
    """Rows in order of bucket, extra and id: every own row with the one after it."""

    def rows_of(rows: list[tuple], texts: list[str]) -> pa.RecordBatch:
        n = len(rows) - 1
        pairs = [k for k in range(n) if not rows[k][2] and rows[k][0] == rows[k + 1][0]]
        edited = [_edited(texts[k], texts[k + 1]) for k in pairs]
        own = spot_sets(pa.array(texts, pa.large_string()), size)
        other = spot_sets(pa.array(edited, pa.large_string()), size) if edited else []
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[k][1] for k in pairs], pa.int64()),
                pa.array([len(texts[k]) for k in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([fingerprint(own[k]) for k in pairs], pa.string()),
                pa.array([fingerprint(s) for s in other], pa.string()),
                pa.array([likeness(own[k], s, least) for k, s in zip(pairs, other)], pa.float64()),
                pa.array([likeness(own[k], own[k + 1], least) for k in pairs], pa.float64()),
            ],
            ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        texts: list[str] = []
        for part in slices(batches, "_text"):
            rows += list(zip(*(part.column(k).to_pylist() for k in range(3))))
            texts += [t or "" for t in part.column(3).to_pylist()]
            if len(rows) > 1:
                yield rows_of(rows, texts)
                rows, texts = rows[-1:], texts[-1:]

    return run


def _dealt(cuts: np.ndarray, firsts: np.ndarray, buckets_of_firsts: np.ndarray):
    """Buckets of an id: its own, and the one before if it is the first of its own."""

    @F.pandas_udf("array<struct<bucket:int,extra:boolean>>")
    def deal(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy()
        own = np.searchsorted(cuts, values, "right")
        place = np.minimum(np.searchsorted(firsts, values), len(firsts) - 1)
        opens = firsts[place] == values
        before = buckets_of_firsts[place - 1]  # of the very first: the last bucket
        return pd.Series(
            [
                [{"bucket": int(b), "extra": False}] + ([{"bucket": int(p), "extra": True}] if o else [])
                for b, p, o in zip(own, before, opens)
            ]
        )

    return deal


COMPARED = (
    "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def edited_neighbours(
    docs: DataFrame, least: float = 0.0, chain: int = CHAIN, bucket_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for each row."""
    texts = docs.select(
        F.coalesce(whole_id(docs, id_col), F.lit(NO_ID)).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    )
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = min(max(1, -(-size // bucket_bytes)), MOST_BUCKETS)
    ids = texts.select("_id")
    parts = [k / buckets for k in range(1, buckets)]
    cuts = np.unique(np.array(ids.approxQuantile("_id", parts, 0.25 / buckets) if parts else [], np.int64))
    bucket = _bucket(cuts)
    found = ids.groupBy(bucket("_id").alias("bucket")).agg(F.min("_id").alias("first")).collect()  # one row for each bucket
    found = sorted((r["first"], r["bucket"]) for r in found)
    if not found:
        return texts.selectExpr(f"_id AS {id_col}", *(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in COMPARED.split(", ")[1:])).limit(0)
    firsts, numbers = np.array([f for f, _ in found], np.int64), np.array([b for _, b in found], np.int64)
    dealt = texts.withColumn("_to", F.explode(_dealt(cuts, firsts, numbers)("_id"))).select("_to.bucket", "_id", "_to.extra", "_text")
    ordered = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "extra", "_id", F.xxhash64("_text"))
    made = ordered.mapInArrow(_compare(chain, least), COMPARED)
    own = F.when(F.col("_id") != NO_ID, F.col("_id"))
    return made.select(own.alias(id_col), *[c.split()[0] for c in COMPARED.split(", ")[1:]])


def _bucket(cuts: np.ndarray):
    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    return bucket


def _spots(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            sets = spot_sets(part.column(1), size)
            keys = [hashlib.sha256(s.tobytes()).hexdigest() for s in sets]
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            spots = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.string()), spots], ["_id", "key", "spots"])

    return run


def near_matches(docs: DataFrame, least: float = 0.5, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_spots, class_id)`` for each row: the least id that a chain of pairs of at least ``least`` likeness leads to.

    Rows without an id take part; a class of them alone has no id.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1: without a least likeness nothing can be pruned")
    texts = docs.select(whole_id(docs, id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = materialize(texts.mapInArrow(_spots(chain), "_id long, key string, spots array<long>"), "spots")
    sets = materialize(rows.groupBy("key").agg(F.first("spots").alias("spots")).withColumn("n", F.size("spots")), "spot-sets")

    own = sets.select("key", "n", F.explode("spots").alias("spot"))
    counts = own.groupBy("spot").agg(F.count(F.lit(1)).alias("seen"))
    by_rarity = own.join(counts, "spot").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("seen", "spot"))).alias("spots"))
    # a pair of this likeness shares at least least * n spots of either set, so one of these
    rare = F.slice("spots", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    # as length_partition
    partition = F.col("n") if least == 1 else F.floor(F.log("n") / -math.log(least) + 1e-9)
    cells = by_rarity.select("key", "n", partition.cast("long").alias("part"), F.explode(rare).alias("s"))
    cells = materialize(cells.where("s.seen > 1").select("key", "n", "part", F.col("s.spot").alias("spot")), "spot-cells")

    home = cells.select("spot", "part", F.col("key").alias("v"), F.col("n").alias("n_v"))
    step = F.explode(F.array(F.lit(0), F.lit(1)))
    come = cells.withColumn("step", step).select(
        "spot", (F.col("part") + F.col("step")).alias("part"), "step", F.col("key").alias("u"), F.col("n").alias("n_u")
    )
    met = come.join(home, ["spot", "part"]).where("step = 1 OR u < v")
    fits = F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * least - 1e-9
    pairs = met.where(fits).select("u", "v").distinct()
    left = sets.select(F.col("key").alias("u"), F.col("spots").alias("a"))
    right = sets.select(F.col("key").alias("v"), F.col("spots").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    alike = pairs.join(left, "u").join(right, "v").where(shared / (F.size("a") + F.size("b") - shared) >= least).select("u", "v")

    classes = connected_components(alike).select(F.col("node").alias("key"), "component")
    placed = rows.select("_id", "key", F.size("spots").cast("long").alias("n_spots")).join(classes, "key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "key"))
    names = placed.groupBy("component").agg(F.min("_id").alias("class_id"))
    return placed.join(names, "component").select(F.col("_id").alias(id_col), "n_spots", "class_id")
