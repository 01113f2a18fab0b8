"""Near-duplicate groups by HyperMinHash registers (Yu and Weber, 2017).

A text's distinct word shingles are hashed once. The top bits of a hash choose one of 256 registers; of the
smallest hash there, a register keeps how many zero bits lead and the ten bits after the first one.
Empty registers borrow from filled ones by a fixed order of donors (densification), so that short texts
can be banded too. Bands of five registers name buckets; 51 bands miss a pair at the threshold of 0.8 with
probability (1 - 0.8**5)**51 < 2e-9.

How groups of any size stay cheap and whole:

* Texts with equal shingle sets are one class, which its smallest id stands for.
* Buckets with the same members are one bucket.
* Every member is first compared with the smallest member of its bucket. The members of a large bucket are dealt over slices of
  about ``STAR_ROWS``, and each slice gets a copy of that one member. Confirmed links make components.
  Only members of buckets of three or more that are not yet of one component are compared across
  components, block by block, and nothing but confirmed links leaves the task.
* Candidates pass the collision-corrected Jaccard estimate with five standard errors to spare; what passes is
  confirmed on the full shingle sets in whole numbers.

Null and empty texts have no shingles and are linked with nothing; rows that repeat an id and a text
give repeated rows. Columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import U, bytes_of, chain, find_words, give_back, mix, slices, whole_id, word_hashes
from logtide.operators.components import connected_components
from logtide.scratch import materialize, shuffled

REGISTERS = 256
REGISTER_BITS = 8
MANTISSA_BITS = 10
BAND_ROWS = 5
BANDS = REGISTERS // BAND_ROWS
BLOCK_ROWS = 2048
STAR_ROWS = 1000
BLOCK_BYTES = 16 << 20
ERRORS_TO_SPARE = 5.0


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text of fewer words is one shingle."""
    words = find_words(texts)
    hashes = word_hashes(words)
    joined = chain(hashes, size)
    for t in range(len(words.first) - 1):
        a, b = int(words.first[t]), int(words.first[t + 1])
        if b - a >= size:
            yield np.unique(joined[a : b - size + 1])
        elif b > a:
            yield mix(chain(hashes[a:b], b - a) + U(b - a))
        else:
            yield np.zeros(0, U)


def _donors() -> np.ndarray:
    """The order in which an empty register asks others: 64 draws for each register."""
    draw = np.arange(64 * REGISTERS, dtype=U).reshape(64, REGISTERS)
    return (mix(draw + U(0x1234567)) % U(REGISTERS)).astype(np.int64)


def registers(smallest: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers of many texts from the smallest hash in each register, as they are and densified; -1: empty."""
    with np.errstate(over="ignore"):
        rest = smallest << U(REGISTER_BITS)
    lead = np.full(rest.shape, 64 - REGISTER_BITS, np.int64)
    some = rest > 0
    # frexp would round 64-bit numbers up; the top half and the bottom half are exact
    high, low = (rest >> U(32)).astype(np.int64), (rest & U(0xFFFFFFFF)).astype(np.int64)
    top = np.where(high > 0, np.frexp(high.astype(float))[1] + 32, np.frexp(low.astype(float))[1])
    lead[some] = 64 - top[some]
    with np.errstate(over="ignore"):
        after = (rest << (np.minimum(lead, 62) + 1).astype(U)) >> U(64 - MANTISSA_BITS)
    own = (np.minimum(lead, 62).astype(np.int64) << MANTISSA_BITS) | after.astype(np.int64)
    own = np.where(filled, own, -1)
    dense = own.copy()
    donors = _donors()
    row, col = np.nonzero((dense < 0) & filled.any(axis=1)[:, None])
    for draw in donors:
        if not len(row):
            break
        got = own[row, draw[col]]
        dense[row[got >= 0], col[got >= 0]] = got[got >= 0]
        row, col = row[got < 0], col[got < 0]
    for step in range(1, REGISTERS):  # nearly empty texts: the next filled register from the last draw on
        if not len(row):
            break
        got = own[row, (donors[-1][col] + step) % REGISTERS]
        dense[row[got >= 0], col[got >= 0]] = got[got >= 0]
        row, col = row[got < 0], col[got < 0]
    return own, dense


def band_keys(dense: np.ndarray) -> np.ndarray:
    """A 64-bit bucket name for each band of each text."""
    used = dense[:, : BANDS * BAND_ROWS].reshape(len(dense), BANDS, BAND_ROWS).astype(U)
    out = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=U)), (len(dense), BANDS)).copy()
    with np.errstate(over="ignore"):
        for k in range(BAND_ROWS):
            out = mix(out * U(0x9E3779B97F4A7C15) + used[:, :, k])
    return out


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(REGISTERS, dtype=U)) << U(64 - REGISTER_BITS)
        for part in slices(batches, "_text"):
            n = part.num_rows
            count, names = np.zeros(n, np.int32), []
            smallest, filled = np.zeros((n, REGISTERS), U), np.zeros((n, REGISTERS), bool)
            for t, found in enumerate(shingle_sets(part.column(1), size)):
                count[t] = len(found)
                names.append(mix(found).sum(dtype=U) if len(found) else U(0))
                if len(found):
                    at = np.searchsorted(found, edges)
                    has = np.diff(np.append(at, len(found))) > 0
                    smallest[t, has], filled[t] = found[at[has]], has
            own, dense = registers(smallest, filled)
            keys = band_keys(dense).astype(np.int64)
            known = count > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(known * BANDS)]).astype(np.int32)),
                pa.array(keys[known].ravel()),
            )
            # the sum of mixed hashes and their number name the set; a second sum makes chance agreement hopeless
            second = [int(x) for x in _second_names(smallest, filled)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(count),
                    pa.array(np.array(names, U).astype(np.int64)),
                    pa.array(np.array(second, U).astype(np.int64)),
                    pa.array([x.tobytes() for x in own.astype(np.int16)], pa.binary()),
                    lists,
                ],
                ["_id", "n_shingles", "set_a", "set_b", "registers", "bands"],
            )

    return run


def _second_names(smallest: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """A name from the smallest hash of every register, in full."""
    out = np.zeros(len(smallest), U)
    with np.errstate(over="ignore"):
        for k in range(REGISTERS):
            out = mix(out + np.where(filled[:, k], smallest[:, k], U(k)))
    return out


SKETCH = "_id long, n_shingles int, set_a long, set_b long, registers binary, bands array<long>"


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate corrected for registers that agree by chance, and the number of registers compared."""
    either = np.maximum(((a >= 0) | (b >= 0)).sum(axis=1), 1)
    equal = ((a == b) & (a >= 0)).sum(axis=1)
    large, small = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    ratio = large / np.maximum(small, 1)
    by_chance = 0.169919487159739 * 2.0 ** (REGISTER_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return (equal - by_chance) / either, either


def _allowed(a, b, n_a, n_b, threshold: float) -> np.ndarray:
    """Pairs that may reach the threshold: set sizes exactly, registers with a margin."""
    got, either = estimate(a, b, n_a, n_b)
    margin = ERRORS_TO_SPARE * np.sqrt(threshold * (1 - threshold) / either) + 1 / either
    return (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9) & (got >= threshold - margin)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int16).reshape(-1, REGISTERS)


def _estimate_pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            side = lambda k: np.frombuffer(bytes_of(batch.column(k))[0], np.int16).reshape(-1, REGISTERS)
            keep = _allowed(
                side(2), side(3), batch.column(4).to_numpy(False), batch.column(5).to_numpy(False), threshold
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(keep)) for k in (0, 1, 6)], ["a", "b", "slice"]
            )

    return run


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Entries that two ordered sets share."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = _shared(x, y)
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _across(percent: int):
    """Pairs of different components that a confirmed link joins, of two blocks of one group."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, one, other = key
        found = []
        left, right = rows[rows["block"] == one], rows[rows["block"] == other]
        reg_r, n_r = _matrix(right["registers"]), right["n_shingles"].to_numpy()
        id_r, comp_r = right["_id"].to_numpy(), right["component"].to_numpy()
        set_r = [np.frombuffer(x, U) for x in right["shingles"]]
        for own, n, name, comp, mine in zip(*(left[c] for c in ("registers", "n_shingles", "_id", "component", "shingles"))):
            near = np.flatnonzero((comp_r != comp) & (id_r > name if one == other else id_r != name))
            if len(near):
                own = np.broadcast_to(np.frombuffer(own, np.int16), (len(near), REGISTERS))
                near = near[_allowed(own, reg_r[near], np.full(len(near), n), n_r[near], percent / 100)]
                mine = np.frombuffer(mine, U)
                found += [(min(comp, comp_r[k]), max(comp, comp_r[k])) for k in near if _linked(mine, set_r[k], percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64").drop_duplicates()

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            sets = [x.tobytes() for x in shingle_sets(part.column(1), size)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["_id", "shingles"])

    return run


def _confirm(percent: int):
    """Pairs whose full sets reach the threshold, counted in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(v.as_buffer(), U) for v in batch.column(k)) for k in (2, 3))
            mask = pa.array([_linked(x, y, percent) for x, y in zip(*sets)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], ["a", "b"])
        give_back()

    return run


def _components(links: DataFrame) -> DataFrame:
    """``(_id, component)`` of all ends of ``links(a, b)``."""
    found = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return materialize(found.withColumnRenamed("node", "_id"), "groups")


def _centers(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The row of each centre ``a``, once for every slice of its star."""
    return pairs.select("a", "slice").distinct().join(rows, "a")


def _left_over(members: DataFrame, groups: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components linked with each other, by members of buckets that confirmed stars have not made one component.

    Members of such buckets that hang together make one group. Each pair of a group's blocks is one
    task's work: registers and sizes rule pairs out, full sets confirm the rest, and only the names of linked components
    leave the task.
    """
    named = members.where("members > 2").join(groups, "_id", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "_id")), "named")
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    left = materialize(named.join(mixed.select("key"), "key", "left_semi"), "mixed")
    if left.isEmpty():
        return left.selectExpr("_id AS a", "_id AS b")
    together = _components(left.select(F.col("center").alias("a"), F.col("_id").alias("b")))
    rows = left.select("_id", "component").distinct().join(together.withColumnRenamed("component", "group"), "_id")
    sizes = reps.select("_id", "n_shingles")
    stats = rows.join(sizes, "_id").groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("s") * 8 / BLOCK_BYTES)).cast("int")
    dealt = rows.join(stats.select("group", blocks.alias("blocks")), "group")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "_id", "group", "component", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other")
    )
    full = dealt.join(reps.select("_id", "registers", "n_shingles"), "_id").join(sets, "_id")
    return full.groupBy("group", "one", "other").applyInPandas(_across(percent), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row; links join texts of Jaccard >= percent / 100.

    A component is named by its smallest id; a row without an id is named by null and kept.
    """
    texts = docs.select(whole_id(docs, id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    sketches = materialize(texts.mapInArrow(_sketch(shingle), SKETCH), "sketches")
    known = sketches.where("n_shingles > 0 AND _id IS NOT NULL")
    firsts = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("_id").alias("first"))
    firsts = materialize(firsts, "classes")
    reps = known.join(firsts.select(F.col("first").alias("_id")), "_id", "left_semi")

    rows = reps.select("_id", F.explode("bands").alias("key")).distinct()
    mark = F.xxhash64("_id")
    live = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("_id").alias("center"), F.bit_xor(mark).alias("x"), F.sum(mark % 1000003).alias("s")
    ).where("members > 1")
    live = live.groupBy("members", "center", "x", "s").agg(F.min("key").alias("key")).drop("x", "s")
    members = materialize(rows.join(live, "key"), "buckets")

    stars = members.where("_id != center").groupBy(F.col("center").alias("a"), F.col("_id").alias("b")).agg(F.max("members").alias("m"))
    slices = F.ceil(F.col("m") / STAR_ROWS).cast("int")
    stars = materialize(stars.select("a", "b", F.pmod(F.xxhash64("b"), slices).cast("int").alias("slice")), "stars")
    side = lambda k: reps.select(F.col("_id").alias(k), F.col("registers").alias(f"r{k}"), F.col("n_shingles").alias(f"n{k}"))
    sketched = stars.join(side("b"), "b").join(_centers(stars, side("a")), ["a", "slice"])
    sketched = sketched.select("a", "b", "ra", "rb", "na", "nb", "slice")
    pairs = materialize(sketched.mapInArrow(_estimate_pairs(percent / 100), "a long, b long, slice int"), "candidates")

    ends = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id")))
    wanted = ends.union(members.where("members > 2").select("_id")).distinct()
    sets = texts.join(wanted, "_id", "left_semi").select("_id", "_text").mapInArrow(_sets(shingle), "_id long, shingles binary")
    sets = materialize(sets, "sets")
    full = lambda k: sets.select(F.col("_id").alias(k), F.col("shingles").alias(f"s{k}"))
    joined = pairs.join(full("b"), "b").join(_centers(pairs, full("a")), ["a", "slice"]).select("a", "b", "sa", "sb")
    links = materialize(joined.mapInArrow(_confirm(percent), "a long, b long"), "links")
    groups = _components(links)
    more = materialize(_left_over(members, groups, reps, sets, percent), "links")

    classes = firsts.join(groups.withColumnRenamed("_id", "first"), "first", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "first").alias("component_id")
    )
    if not more.isEmpty():  # a component's links are known: only its name goes on
        merged = _components(more).withColumnRenamed("_id", "component_id")
        last = F.coalesce("component", "component_id").alias("component_id")
        classes = classes.join(shuffled(merged), "component_id", "left").select("set_a", "set_b", "n_shingles", last)
    own = sketches.select("_id", "n_shingles", "set_a", "set_b").where("n_shingles > 0 AND _id IS NOT NULL")
    linked = own.join(classes, ["set_a", "set_b", "n_shingles"])
    alone = sketches.where("n_shingles = 0 OR _id IS NULL").select("_id", "n_shingles", F.col("_id").alias("component_id"))
    out = linked.select("_id", "n_shingles", "component_id").unionByName(alone)
    return out.select(
        F.col("_id").alias(id_col),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
