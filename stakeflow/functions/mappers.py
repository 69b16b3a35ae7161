"""Pure Column expressions: id sanitation, category mappers, buckets, scores.

Every function takes and returns ``pyspark.sql.Column`` objects, so it stays
inside whole-stage codegen and can be used in any ``select``/``withColumn``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's rules; listed in rule order).
# ---------------------------------------------------------------------------
NULL_SENTINELS = ("", "nan", "none", "null")
UNKNOWN_SENTINELS = ("unknown", "nan", "none", "null", "")

GAME_TYPE_RULES = [
    ("live_dealer", ["live", "baccarat", "blackjack", "roulette", "sicbo", "sic bo",
                     "dragon", "teen patti", "andar", "football studio", "fan tan",
                     "bac bo"]),
    ("slot", ["slot", "starburst", "fruit", "reel"]),
    ("table", ["table", "poker"]),
    ("crash", ["crash", "aviator", "cricket crash", "quantum x", "cosmox"]),
    ("instant_win", ["instant", "scratch", "keno"]),
]

PROVIDER_RULES = [
    ("Evolution", ["evolution", "evosw", "evo"]),
    ("EZUGI", ["ezugi"]),
    ("Spribe", ["spribe"]),
    ("OnlyPlay", ["onlyplay"]),
    ("HUB88", ["hub88"]),
    ("PeterAndSons", ["peterandsons", "peter & sons"]),
]

DEVICE_RULES = [
    ("mobile", ["android", "ios", "mobile", "phone"]),
    ("desktop", ["desktop", "web", "windows", "mac", "linux", "pc"]),
    ("tablet", ["tablet"]),
]

VALID_GAME_TYPES = ["slot", "table", "live_dealer", "crash", "instant_win", "unknown"]
VALID_PROVIDERS = ["HUB88", "Evolution", "EZUGI", "Spribe", "OnlyPlay", "PeterAndSons", "unknown"]
VALID_DEVICE_TYPES = ["mobile", "desktop", "tablet", "unknown"]
VALID_ENTRY_POINTS = ["livecasino", "casino", "sportsbook", "direct", "search", "lobby", "unknown"]

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
TIME_BUCKETS = ["morning", "afternoon", "evening", "late_night"]
STAKE_WEIGHTS = {"low": 1, "medium": 2, "high": 3}
POPULARITY_LABELS = ["cold", "warm", "hot", "blockbuster"]
OBJECT_ID_PATTERN = "^[0-9a-f]{24}$"

USER_TOKEN_COLUMNS = ["preferred_time_of_day", "preferred_day_of_week",
                      "preferred_device", "preferred_entry_point"]
ITEM_TOKEN_COLUMNS = ["game_type", "provider", "popularity_bucket"]

TOKEN_LABEL_PREFIXES = [
    ("preferred_time_of_day:", "time="),
    ("preferred_day_of_week:", "day="),
    ("preferred_device:", "device="),
    ("preferred_entry_point:", "entry="),
    ("game_type:", "game_type="),
    ("provider:", "provider="),
    ("popularity_bucket:", "pop_bucket="),
]


def round_to(c, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(c * 10^d) / 10^d``.

    This follows the binary value (as Python's ``round`` does) and is evaluated
    identically by Spark and DuckDB; Spark's own ``round(c, d)`` rounds the
    decimal string half-up and disagrees on values such as 0.13445.
    """
    scale = float(10 ** digits)
    return F.round(_c(c) * scale) / scale


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_contains(value: Column, keys) -> Column:
    return reduce(lambda a, b: a | b, [value.contains(k) for k in keys])


# ---------------------------------------------------------------------------
# B9 / B10 / B12  id handling
# ---------------------------------------------------------------------------
def clean_id(c) -> Column:
    """``trim(cast(c as string))``; NULL stays NULL."""
    return F.trim(_c(c).cast("string"))


def is_null_like(c) -> Column:
    """True for NULL and for the text sentinels '', nan, none, null (any case)."""
    v = F.lower(F.trim(_c(c).cast("string")))
    return _c(c).isNull() | v.isin(*NULL_SENTINELS)


def id_before_dot(c) -> Column:
    """Text before the first '.' (``"12.0"`` -> ``"12"``), trimmed."""
    return F.trim(F.substring_index(_c(c).cast("string"), ".", 1))


def is_objectid_like(c) -> Column:
    return F.coalesce(F.lower(F.trim(_c(c).cast("string"))).rlike(OBJECT_ID_PATTERN), F.lit(False))


# ---------------------------------------------------------------------------
# B13 - B19  category mappers
# ---------------------------------------------------------------------------
def map_game_type(c) -> Column:
    v = F.lower(F.trim(_c(c).cast("string")))
    expr = None
    for label, keys in GAME_TYPE_RULES:
        cond = F.coalesce(_any_contains(v, keys), F.lit(False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("unknown")


def map_provider(c) -> Column:
    raw = _c(c).cast("string")
    v = F.lower(F.trim(raw))
    expr = F.when(raw.isNull() | v.isin(*NULL_SENTINELS) | v.rlike(OBJECT_ID_PATTERN), "unknown")
    for label, keys in PROVIDER_RULES:
        expr = expr.when(_any_contains(v, keys), label)
    return expr.otherwise(F.trim(raw))


def map_device_type(c) -> Column:
    v = F.lower(F.trim(F.coalesce(_c(c).cast("string"), F.lit("unknown"))))
    expr = None
    for label, keys in DEVICE_RULES:
        cond = _any_contains(v, keys)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("unknown")


def map_entry_point(c) -> Column:
    v = F.replace(F.lower(F.trim(F.coalesce(_c(c).cast("string"), F.lit("unknown")))),
                  F.lit(" "), F.lit("_"))
    return (
        F.when(v.isin(*NULL_SENTINELS), "unknown")
        .when(v.contains("live"), "livecasino")
        .when(v.contains("sport"), "sportsbook")
        .when(v == "home", "direct")
        .when(v.isin("direct", "lobby"), v)
        .when(v.contains("casino"), "casino")
        .otherwise(v)
    )


def map_time_of_day(ts) -> Column:
    h = F.hour(_c(ts))
    return (
        F.when(h.between(6, 11), "morning")
        .when(h.between(12, 17), "afternoon")
        .when(h.between(18, 21), "evening")
        .otherwise("late_night")
    )


def day_name(ts) -> Column:
    """Full English weekday name (``Monday``)."""
    return F.date_format(_c(ts), "EEEE")


def map_day_of_week(ts) -> Column:
    return F.lower(day_name(ts))


def map_outcome(c) -> Column:
    """WIN -> net_positive; LOSS/LOSE -> net_negative; else break_even (no trim)."""
    v = F.upper(_c(c).cast("string"))
    return (
        F.when(v == "WIN", "net_positive")
        .when(v.isin("LOSS", "LOSE"), "net_negative")
        .otherwise("break_even")
    )


def win_flag(c) -> Column:
    """1 when result is exactly 'WIN' (case-sensitive), else 0 (NULL -> 0)."""
    return F.coalesce((_c(c) == "WIN").cast("int"), F.lit(0))


# ---------------------------------------------------------------------------
# B3 / B4 / B11 / B20 / B21  parsing and derived columns
# ---------------------------------------------------------------------------
def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 for TIMESTAMP_NTZ (or UTC TIMESTAMP) input."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz"))


def seconds_between(start, end) -> Column:
    """``end - start`` in (fractional) seconds."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def session_id(id_col) -> Column:
    return F.concat(F.lit("sess_"), _c(id_col).cast("string"))


def game_slug(name) -> Column:
    """``game_`` + lower, non-alphanumerics to '_', strip '_'."""
    s = F.regexp_replace(F.lower(_c(name).cast("string")), "[^a-z0-9]+", "_")
    return F.concat(F.lit("game_"), F.regexp_replace(s, "^_+|_+$", ""))


def first_element_fields(arr, fields) -> list[Column]:
    """B1: fields of the first array element; NULL when array NULL/empty."""
    first = F.get(_c(arr), 0)
    return [first.getField(f).alias(f) for f in fields]


# ---------------------------------------------------------------------------
# B17 / B22 / B23 / B24 / B35  buckets
# ---------------------------------------------------------------------------
def stake_tier(stake, q1: float, q2: float) -> Column:
    s = _c(stake)
    return F.when(s <= F.lit(q1), "low").when(s <= F.lit(q2), "medium").otherwise("high")


def exit_type(duration, returned) -> Column:
    d = _c(duration)
    return (
        F.when(d == 0, "unknown")
        .when(d < 30, "quick_exit")
        .when(_c(returned), "returned_quickly")
        .otherwise("natural_end")
    )


def eda_exit_type(duration, returned) -> Column:
    """Missing duration -> no_session_data, so 0 s counts as quick_exit."""
    d = _c(duration)
    return (
        F.when(d.isNull(), "no_session_data")
        .when(d < 30, "quick_exit")
        .when(_c(returned), "returned_quickly")
        .otherwise("natural_end")
    )


def session_tier(n) -> Column:
    v = _c(n)
    return F.when(v <= 5, "1_5").when(v <= 20, "6_20").otherwise("21_plus")


def right_closed_bucket(c, edges, labels, missing="nan") -> Column:
    """(e0, e1] -> labels[0], ...; out of range / NULL -> ``missing``."""
    v = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr.otherwise(missing)


# ---------------------------------------------------------------------------
# B25 - B29  engagement and implicit scores
# ---------------------------------------------------------------------------
def stake_weight(tier) -> Column:
    t = _c(tier)
    expr = None
    for k, w in STAKE_WEIGHTS.items():
        expr = F.when(t == k, F.lit(w)) if expr is None else expr.when(t == k, F.lit(w))
    return expr.otherwise(F.lit(1))


def engagement_intensity(duration, rounds, tier) -> Column:
    return (
        F.log1p(F.greatest(_c(duration), F.lit(0.0))) * 0.5
        + F.greatest(_c(rounds), F.lit(0)) * 0.3
        + stake_weight(tier) * 0.2
    )


def recency_weight(days) -> Column:
    d = _c(days)
    return F.when(d <= 7, 1.0).when(d <= 30, 0.7).when(d <= 90, 0.4).otherwise(0.2)


def implicit_score(n, engagement, p95, win_rate, recency_days) -> Column:
    freq = F.least(_c(n) / 20.0, F.lit(1.0))
    eng = F.least(_c(engagement) / F.lit(max(p95 if p95 is not None else 0.0, 1e-6)), F.lit(1.0))
    quality = F.coalesce(_c(win_rate), F.lit(0.0))
    return round_to(0.40 * freq + 0.25 * eng + 0.15 * quality + 0.20 * recency_weight(recency_days), 4)


# ---------------------------------------------------------------------------
# B32 / B33 / B36  tokens
# ---------------------------------------------------------------------------
def tokens(columns) -> Column:
    """``prefix:value`` tokens, one per column (NULL values give ``prefix:`` skipped)."""
    return F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(c).cast("string")))
        for c in columns
    ]))


def token_label(tok, max_length: int = 36) -> Column:
    t = _c(tok)
    expr = None
    for prefix, repl in TOKEN_LABEL_PREFIXES:
        cond = t.startswith(prefix)
        val = F.concat(F.lit(repl), F.substring(t, len(prefix) + 1, 1 << 20))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    label = expr.otherwise(t)
    return F.when(F.length(label) > max_length,
                  F.concat(F.substring(label, 1, max_length - 1), F.lit("..."))).otherwise(label)


def fill_by_type(df, numeric_value=0, string_value="unknown"):
    """Numeric NULL -> 0, string NULL -> 'unknown'; timestamps untouched."""
    num = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")
           or t.startswith("decimal")]
    txt = [c for c, t in df.dtypes if t == "string"]
    out = df
    if num:
        out = out.fillna(numeric_value, subset=num)
    if txt:
        out = out.fillna(string_value, subset=txt)
    return out


def dot(a, b) -> Column:
    """H9 building block: inner product of two numeric arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)
