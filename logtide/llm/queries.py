"""The registered queries of the operators for training text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm.fmindex import contamination
from logtide.llm.hyperminhash import near_duplicates
from logtide.llm.infill import digests, infill, infill_plan, store_frames
from logtide.llm.langmodel import language_scores
from logtide.llm.linecrf import fit_quality, score_quality
from logtide.llm.packing import pack
from logtide.llm.preferences import broken_off, preference_segments
from logtide.llm.spotsigs import edited_neighbours
from logtide.llm.superkmers import remove_repeats
from logtide.llm.textdensity import main_texts
from logtide.llm.tokens import WHOLE, count_tokens
from logtide.llm.warc import read_warc, write_warc
from logtide.llm.whitening import whiten
from logtide.llm.words import small_batches
from logtide.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register under the function's name, with SQL for the same rows where there is some."""

    def add(make: Query) -> Query:
        QUERIES[make.__name__] = make
        if sql:
            ORACLE[make.__name__] = sql
        return make

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER_AZ}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d),
c AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.c AS component_id, doc_id = c.c AS kept
FROM documents JOIN c ON c.d = doc_id LEFT JOIN n USING (doc_id)
"""


@query(OP6_SQL)
def op6_hyperminhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), shingle=2, percent=80)


OP9_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS k
  FROM w WHERE len(w) >= 20),
f AS (SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY k) AS f FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE (doc_id, i) > f),
g AS (SELECT doc_id, list(p) AS p, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN g.n IS NULL THEN w ELSE list_transform(
    list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g.p, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""


@query(OP9_SQL)
def op9_superkmers(spark, folder):
    return remove_repeats(table(spark, folder, "documents"), window=20, digest=True)


OP7_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER_AZ}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER_AZ}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
k AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, unnest(CASE WHEN len(w) <= 10 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS k FROM b WHERE len(w) > 0),
l AS (SELECT DISTINCT n FROM k),
p AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k
  FROM d, l WHERE len(w) >= n),
h AS (SELECT doc_id, i, p.n, item FROM p JOIN k USING (n, k)),
c AS (SELECT doc_id, count(DISTINCT u) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS u FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query(OP7_SQL)
def op7_fmindex(spark, folder):
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)


def held_out(name: str = "doc_id", parts: int = 4):
    """Rows that no fit may see."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % parts == 2, F.lit(False))


def quality_model(docs: DataFrame, spark: SparkSession, folder: str):
    return fit_quality(docs, table(spark, folder, "labels"), ~held_out())


@query()
def op1_linecrf(spark, folder):
    docs = table(spark, folder, "documents")
    scored = score_quality(docs.select("doc_id", "text"), quality_model(docs, spark, folder))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


OP3_SQL = """
WITH c AS (SELECT conv_id, turn, min((coalesce(role, ''), coalesce(text, ''))) AS c FROM conversations
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
e AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
x AS (SELECT conv_id, turn, min((coalesce(role, ''), coalesce(CASE WHEN turn = last AND role = 'assistant' THEN left(text, length(text) // 2) ELSE text END, ''))) AS x
    FROM conversations LEFT JOIN e USING (conv_id) WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
b AS (SELECT conv_id, turn, c[1] AS cr, c[2] AS ct, x[1] AS xr, x[2] AS xt FROM c JOIN x USING (conv_id, turn)),
d AS (SELECT conv_id, min(CASE WHEN cr <> xr OR ct <> xt THEN turn END) AS stop FROM b GROUP BY conv_id),
s AS (
  SELECT conv_id, turn, CASE WHEN stop IS NULL OR turn < stop THEN 'prompt' ELSE 'chosen' END AS part, cr AS role, ct AS t FROM b JOIN d USING (conv_id)
  UNION ALL SELECT conv_id, turn, 'rejected', xr, xt FROM b JOIN d USING (conv_id) WHERE turn >= stop)
SELECT conv_id, part, turn, role, '<|im_start|>' || role || chr(10) || t || '<|im_end|>' || chr(10) AS segment,
  CAST(13 + length(role) + CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 0 ELSE length(t) + 11 END AS INTEGER) AS train_from FROM s
"""


@query(OP3_SQL)
def op3_preferences(spark, folder):
    turns = table(spark, folder, "conversations")
    return preference_segments(turns, broken_off(turns), "conv_id")


@query()
def op10_packing(spark, folder):
    counted = count_tokens(table(spark, folder, "documents"), "byte_bpe_50k.json", chunk=WHOLE)
    return pack(counted, max_tokens=2048, buckets=12, budget=16384, length_col="n_tokens")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, array_to_string(list_transform(range(8), lambda k: translate(
    to_base(CAST('0x' || substr(sha1(html), CAST(5 * k + 1 AS INTEGER), 5) AS BIGINT), 32, 4),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY ALL)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


@query(OP8_SQL)
def op8_warc(spark, folder):
    path = scratch_path(spark, "warc")
    write_warc(table(spark, folder, "pages"), path, least_bytes=0)
    records, _ = read_warc(spark, path, strict=True)  # a page must not be lost without a word
    return records.select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query()
def op2_tokens(spark, folder):
    return count_tokens(table(spark, folder, "documents"), "byte_bpe_50k.json", limit=512)


@query()
def op4_spotsigs(spark, folder):
    return edited_neighbours(table(spark, folder, "documents"))


@query()
def op5_textdensity(spark, folder):
    return main_texts(table(spark, folder, "pages"))


@query()
def op11_whitening(spark, folder):
    return whiten(table(spark, folder, "embeddings"), components=4)


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || doc_id) AS k FROM documents),
h AS (
  SELECT doc_id, t, n, CAST('0x' || k[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || k[9:16] AS BIGINT) % (n + 1) AS b,
    CAST('0x' || k[17:24] AS BIGINT) % 100 AS c, CAST('0x' || k[25:32] AS BIGINT) % 100 AS s FROM d),
f AS (
  SELECT doc_id, t, n, least(a, b) AS a, greatest(a, b) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
      WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, '<P>' || t[1:a] AS p, '<M>' || t[a + 1:b] AS m, '<S>' || t[b + 1:n] AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN s || p || m ELSE p || s || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query(OP12_SQL)
def op12_infill(spark, folder):
    stored = materialize(store_frames(table(spark, folder, "documents")), "frames")
    return digests(infill(infill_plan(stored)))


@query()
def op13_recurrent(spark, folder):
    return language_scores(table(spark, folder, "documents"), held_out(parts=7))
