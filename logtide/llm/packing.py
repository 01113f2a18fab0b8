"""Length buckets of least padding, and token-budget batches inside them.

Texts longer than ``max_tokens`` are cut into pieces, so the histogram of lengths has at most ``max_tokens``
entries, whatever the corpus. Dynamic programming over it picks at most ``buckets`` boundaries so that padding
every piece to its bucket's boundary costs least. A bucket's batches hold ``budget // boundary`` pieces each,
in order of length, id and piece; only its last batch may hold fewer.

The place of a piece in this order comes from one range sort of (length, id, piece) rows without texts:
rows of a sorted partition are numbered as they are written, and partition sizes give the rest, so no
bucket meets in one task.

Lengths are numbers of words ``[^\\x20\\x09-\\x0D]+`` unless ``length_col`` names a column with them. A null or empty
text, or a null length or one below 1, is one row without bucket and batch. Rows that repeat an id are packed each. Columns besides
id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.scratch import materialize


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """Boundaries of least total padding for a histogram with rising lengths, and that padding."""
    n = len(lengths)
    if not n:
        return [], 0
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    pieces = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(lengths * counts)])

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        """Padding of lengths i .. j-1 in one bucket."""
        return lengths[j - 1] * (pieces[j] - pieces[i]) - (tokens[j] - tokens[i])

    starts = np.arange(n)
    best = np.array([0] + [int(cost(np.array([0]), j)[0]) for j in range(1, n + 1)])
    came = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        now, from_ = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            total = best[:j] + cost(starts[:j], j)
            from_[j] = int(total.argmin())
            now[j] = total[from_[j]]
        came.append(from_)
        best = now
    cuts, j = [], n
    for from_ in reversed(came):
        if j == 0:
            break
        cuts.append(int(lengths[j - 1]))
        j = int(from_[j])
    return cuts[::-1], int(best[n])


def pack(
    docs: DataFrame,
    max_tokens: int = 2048,
    buckets: int = 12,
    budget: int = 16384,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """``(doc_id, piece, first_token, n_tokens, bucket, batch, padding)`` for each piece; batches are numbered over all buckets."""
    if budget < max_tokens:
        raise ValueError("a batch must hold one piece of max_tokens at least")
    length = F.col(length_col).cast("long") if length_col else F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(F.col(id_col).alias("_id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).alias("_n"))
    rows = materialize(rows, "lengths")  # the range sort reads its input twice: numbers, not texts
    last = F.floor((F.greatest(F.col("_n"), F.lit(1)) - 1) / max_tokens)
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).select(
        "_id",
        F.col("piece").cast("int").alias("piece"),
        F.least(F.col("_n") - F.col("piece") * max_tokens, F.lit(max_tokens)).cast("int").alias("n_tokens"),
    )
    ordered = pieces.repartitionByRange("n_tokens", "_id", "piece").sortWithinPartitions("n_tokens", "_id", "piece")
    # the id counts rows within a partition, in the order in which they are written
    numbered = materialize(ordered.withColumn("_row", F.monotonically_increasing_id()), "pieces")

    histogram = sorted((r["n_tokens"], r["n"]) for r in numbered.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    empty = sum(n for size, n in histogram if size == 0)
    known = np.array([x for x in histogram if x[0] > 0], np.int64).reshape(-1, 2)
    cuts, _ = best_boundaries(known[:, 0], known[:, 1], buckets)

    part = F.shiftright("_row", 33)
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in sizes])
    # one entry for each partition of the sort
    offsets = docs.sparkSession.createDataFrame(
        [(int(p), int(b) - empty) for (p, _), b in zip(sizes, before)], "_part long, _before long"
    )
    bucket, first, batch_first, size = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long")
    low, batches = 0, 0
    for cut in cuts:
        inside = (F.col("n_tokens") > low) & (F.col("n_tokens") <= cut)
        held = int(known[(known[:, 0] > low) & (known[:, 0] <= cut), 1].sum())
        begin = int(known[known[:, 0] <= low, 1].sum())
        bucket = F.when(inside, F.lit(cut)).otherwise(bucket)
        first = F.when(inside, F.lit(begin).cast("long")).otherwise(first)
        batch_first = F.when(inside, F.lit(batches).cast("long")).otherwise(batch_first)
        size = F.when(inside, F.lit(budget // cut).cast("long")).otherwise(size)
        low, batches = cut, batches - (-held // (budget // cut))
    placed = numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    index = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    return placed.select(
        F.col("_id").alias(id_col),
        "piece",
        (F.col("piece").cast("long") * max_tokens).alias("first_token"),
        "n_tokens",
        bucket.alias("bucket"),
        (batch_first + F.floor((index - first) / size)).cast("long").alias("batch"),
        (bucket - F.col("n_tokens")).alias("padding"),
    )
