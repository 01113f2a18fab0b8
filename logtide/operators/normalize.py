"""Raw logs of any vendor's column layout to canonical, valid, unique records.

Everything up to the validity filter is one narrow projection, so it runs unchanged on a stream and
adds no shuffle. Only de-duplication moves rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logtide.functions.text import hash_below, normalize_endpoint, strip_space
from logtide.functions.times import to_instant
from logtide.operators.numbering import numbered

# The canonical record and the vendor names of its fields.
CANONICAL = [
    "timestamp",
    "service_name",
    "endpoint",
    "method",
    "status_code",
    "latency_ms",
    "bytes_response",
    "user_id",
    "instance_id",
]
ALIASES = {
    "timestamp": ["ts", "time", "@timestamp", "event_time"],
    "service_name": ["svc", "service", "app", "application"],
    "endpoint": ["path", "url", "request_path", "uri"],
    "method": ["http_method", "request_method", "verb"],
    "status_code": ["status", "http_status", "response_code", "http_status_code"],
    "latency_ms": ["latency", "response_time", "duration_ms", "elapsed_ms"],
    "bytes_response": ["response_size", "content_length", "bytes_sent"],
    "user_id": ["user", "userid", "client_id"],
    "instance_id": ["instance", "host", "pod", "server"],
}

REQUIRED = ["timestamp", "service_name", "status_code"]
MEASURES = ["latency_ms", "bytes_response"]
UNKNOWN = "unknown"
STATUS_RANGE = (100, 599)
LATENCY_RANGE = (0, 300_000)
DEDUPE_KEYS = ["timestamp", "service_name", "endpoint", "instance_id"]


def _sources(names: list[str]) -> dict[str, list[int]]:
    """Positions of the input columns that feed each canonical field, in order of preference."""
    at = {name: i for i, name in enumerate(names)}
    return {
        field: [at[n] for n in [field, *ALIASES[field]] if n in at]
        for field in CANONICAL
    }


def map_columns(raw: DataFrame) -> DataFrame:
    """Rename vendor columns to canonical names (exact, case-sensitive match).

    Of several columns for one field the first non-null value counts: the canonical name first, then
    the vendor names in the listed order. Other input columns ride along.
    """
    names = raw.columns
    types = [field.dataType for field in raw.schema.fields]
    # by position: the input may hold names that differ only in case
    plain = raw.toDF(*[f"_{i}" for i in range(len(names))])
    picked, used = [], set()
    for field, positions in _sources(names).items():
        if not positions:
            continue
        used.update(positions)
        columns = [F.col(f"_{p}") for p in positions]
        if len({types[p] for p in positions}) > 1:
            columns = [c.cast("string") for c in columns]
        picked.append(F.coalesce(*columns).alias(field))
    taken = {field.lower() for field in CANONICAL}
    for i, name in enumerate(names):
        if i in used:
            continue
        while name.lower() in taken:
            name += "_source"
        taken.add(name.lower())
        picked.append(F.col(f"_{i}").alias(name))
    return plain.select(*picked)


def check_required(mapped: DataFrame) -> DataFrame:
    """Refuse input without a time, a service or a status, before defaults could hide it."""
    missing = [c for c in REQUIRED if c not in mapped.columns]
    if missing:
        raise ValueError(f"required columns missing after mapping: {missing}")
    return mapped


def add_missing(mapped: DataFrame) -> DataFrame:
    """Fill absent canonical columns: NULL measures, ``unknown`` for the rest."""
    absent = [c for c in CANONICAL if c not in mapped.columns]
    return mapped.withColumns(
        {c: F.lit(None).cast("double") if c in MEASURES else F.lit(UNKNOWN) for c in absent}
    )


def _number(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        # the cast alone would take "1d" and "2f" for numbers
        column = F.regexp_replace(column, r"(?i)(?<=[0-9.])[df]\s*$", "?")
    elif isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return column.cast("double")
    return F.nullif(column.try_cast("double"), F.lit(float("nan")))


def _whole_number(column: Column, dtype: T.DataType) -> Column:
    """An integer, also when written with a zero fraction; anything else is NULL."""
    if isinstance(dtype, T.StringType):
        # the pattern runs only where the plain cast fails
        bare = F.regexp_replace(column, r"^\s*(\d+)\.0*\s*$", "$1")
        return F.coalesce(column.try_cast("int"), bare.try_cast("int"))
    if isinstance(dtype, T.IntegralType):
        return column.try_cast("int")
    return F.when(column == F.floor(column), column.try_cast("int"))


def coerce_types(logs: DataFrame, time_unit: str = "ns") -> DataFrame:
    """Canonical types; what does not parse becomes NULL. A status must be a whole number."""
    types = {f.name: f.dataType for f in logs.schema.fields}
    return logs.withColumns(
        {
            "timestamp": to_instant(F.col("timestamp"), types["timestamp"], time_unit),
            "status_code": _whole_number(F.col("status_code"), types["status_code"]),
            **{c: _number(F.col(c), types[c]) for c in MEASURES},
            "user_id": F.col("user_id").cast("string"),
            "instance_id": F.col("instance_id").cast("string"),
        }
    )


def clean_strings(logs: DataFrame) -> DataFrame:
    """Service lower, method upper, both and the endpoint stripped.

    A NULL service stays NULL and is rejected later; a NULL endpoint or method is one more value.
    """
    text = {c: strip_space(F.col(c).cast("string")) for c in ("service_name", "endpoint", "method")}
    return logs.withColumns(
        {
            "service_name": F.lower(text["service_name"]),
            "endpoint": F.coalesce(text["endpoint"], F.lit(UNKNOWN)),
            "method": F.upper(F.coalesce(text["method"], F.lit(UNKNOWN))),
        }
    )


def reject_rules() -> dict[str, Column]:
    """What makes a record invalid; a record may break several rules."""
    low, high = LATENCY_RANGE
    return {
        "bad_timestamp": F.col("timestamp").isNull(),
        "no_service": F.col("service_name").isNull(),
        "bad_status": F.col("status_code").isNull(),
        "status_out_of_range": F.coalesce(~F.col("status_code").between(*STATUS_RANGE), F.lit(False)),
        "latency_out_of_range": F.coalesce(~F.col("latency_ms").between(low, high), F.lit(False)),
    }


def _rejected() -> Column:
    first, *rest = reject_rules().values()
    for rule in rest:
        first = first | rule
    return first


def keep_valid(logs: DataFrame, watch: Observation | None = None) -> DataFrame:
    """Drop invalid records; ``watch`` receives input and dropped counts without another pass.

    The optimizer moves this filter below the projection and repeats the parsing there, so every
    condition names its column once.
    """
    if watch is not None:
        logs = logs.observe(
            watch,
            F.count(F.lit(1)).alias("input_rows"),
            F.coalesce(F.count_if(_rejected()), F.lit(0)).alias("dropped_rows"),
        )
    low, high = (bound // 100 for bound in STATUS_RANGE)  # 100 to 599 are the hundreds 1 to 5
    hundreds = F.call_function("div", F.col("status_code"), F.lit(100))
    return logs.where(
        F.col("timestamp").isNotNull()
        & F.col("service_name").isNotNull()
        & hundreds.isin(*range(low, high + 1))
        & F.coalesce(F.col("latency_ms").between(*LATENCY_RANGE), F.lit(True))
    )


def reject_reasons(raw: DataFrame, time_unit: str = "ns") -> DataFrame:
    """Rows per broken rule, plus all input rows: one aggregate row, unpivoted."""
    logs = to_canonical(raw, time_unit)
    rules = reject_rules()
    counts = logs.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(_rejected()).alias("rejected_rows"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    return counts.unpivot([], counts.columns, "reason", "row_count")


def mask_endpoints(logs: DataFrame, column: str = "endpoint") -> DataFrame:
    return logs.withColumn(column, normalize_endpoint(F.col(column)))


def dedupe(
    logs: DataFrame, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order`` (default: all other columns, ascending).

    The rank filter is applied before the shuffle as well, so a group of copies shrinks to one row
    per map task and a hot key stays small.
    """
    keys = [k for k in (keys or DEDUPE_KEYS) if k in logs.columns]
    order = order or [c for c in logs.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return logs.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def downsample(
    logs: DataFrame, rate: float = 1.0, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Keep about ``rate`` of the rows, chosen by a hash of their key; 1 or more keeps all."""
    if rate >= 1.0:
        return logs
    parts = [
        F.unix_micros(c).cast("string") if logs.schema[k].dataType == T.TimestampType() else c.cast("string")
        for k in (keys or DEDUPE_KEYS)
        for c in [F.col(k)]
    ]
    return logs.where(hash_below(rate, F.lit(str(seed)), *parts))


SLOT_BITS = 16


def downsample_exact(
    logs: DataFrame, rate: float = 1.0, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Keep exactly ``round(rate * n)`` rows, those whose key has the least hash; 1 or more keeps all.

    The last kept hash is found by counting: rows by the first 16 bits, then those of one slot by the next 16, then the
    few hashes that share these. So nothing is sorted, and the rows are filtered once. Rows of one key share a
    hash; where the cut goes through them, which of them stay is not defined. ``logs`` is read four times: pass a stored table.
    """
    if rate >= 1.0:
        return logs
    parts = [
        F.unix_micros(c).cast("string") if logs.schema[k].dataType == T.TimestampType() else c.cast("string")
        for k in (keys or DEDUPE_KEYS)
        for c in [F.col(k)]
    ]
    hashed = logs.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    digits, left, prefix = SLOT_BITS // 4, round(max(rate, 0.0) * logs.count()), ""
    if not left:
        return logs.limit(0)
    inside = hashed
    for length in (digits, 2 * digits, 32):
        slot = F.substring("_h", 1, length)
        counts = sorted(tuple(r) for r in inside.where(F.startswith("_h", F.lit(prefix))).groupBy(slot).agg(F.count(F.lit(1))).collect())
        for prefix, n in counts:  # at most 65,536 slots, or the hashes that agree in 32 bits
            if n >= left:
                break
            left -= n
    below, last = hashed.where(F.col("_h") < prefix), hashed.where(F.col("_h") == prefix)
    if n > left:
        last = numbered(last, "_place").where(F.col("_place") < left).drop("_place")
    return below.unionByName(last).drop("_h")


def to_canonical(raw: DataFrame, time_unit: str = "ns") -> DataFrame:
    """Mapping, defaults and types: a projection."""
    return coerce_types(add_missing(check_required(map_columns(raw))), time_unit)


def normalize_rows(
    raw: DataFrame, time_unit: str = "ns", watch: Observation | None = None
) -> DataFrame:
    """All row-by-row steps, for batches and streams alike.

    The string clean-up makes no NULL and no value valid, so it only runs on the rows that are kept.
    """
    return mask_endpoints(clean_strings(keep_valid(to_canonical(raw, time_unit), watch)))


def normalize_logs(
    raw: DataFrame,
    sample_rate: float = 1.0,
    order: list[str] | None = None,
    time_unit: str = "ns",
    dedupe_keys: list[str] | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """The whole chain: rows, then duplicates, then the optional sample."""
    rows = normalize_rows(raw, time_unit, watch)
    return downsample(dedupe(rows, dedupe_keys, order), sample_rate)
