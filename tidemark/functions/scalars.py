"""Scalar functions over columns; every one is a composition of built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_date(ts: Column, zone: str) -> Column:
    """The day in ``zone`` of an instant in UTC; independent of the session's zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz")))


def quantize(value: Column, scale: int) -> Column:
    """Rounded half up as a decimal, returned as a double."""
    return F.round(value, scale).cast("double")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b in doubles; null where either is null or b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def values_equal(a: Column, b: Column, scale: int = 8) -> Column:
    """Null-safe equality after rounding."""
    return F.round(a.cast("double"), scale).eqNullSafe(F.round(b.cast("double"), scale))


def availability_date(*stamps: Column) -> Column:
    """The day a row became known: of its first stamp that isn't null."""
    return F.to_date(F.coalesce(*stamps))


def value_fallback(*values: Column) -> Column:
    return F.coalesce(*values)


def normalize_text(text: Column) -> Column:
    """Lower case, blanks collapsed, null as empty."""
    return F.coalesce(F.trim(F.lower(F.regexp_replace(text, r"\s+", " "))), F.lit(""))


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, https without a scheme, no query, fragment or closing slash."""
    full = F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url))
    bare = F.regexp_replace(full, r"[?#].*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([^:]+://[^/]*)", 1))
    path = F.regexp_extract(bare, r"^[^:]+://[^/]*(.*)$", 1)
    return F.concat(head, F.regexp_replace(path, "/+$", ""))


def keyword_match(text: Column, keyword: str) -> Column:
    """Phrases match anywhere; a single word only with no word character on either side."""
    if " " in keyword:
        return text.contains(keyword)
    return text.rlike(rf"(?U)(?<!\w){quoted(keyword)}(?!\w)")


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """Those of ``keywords`` that ``keyword_match`` finds: one pass for all single words, one for each phrase."""
    single, phrases = [k for k in keywords if " " not in k], [k for k in keywords if " " in k]
    found = F.array_compact(F.array(*(F.when(text.contains(p), F.lit(p)) for p in phrases)).cast("array<string>"))
    if single:
        either = "|".join(map(quoted, sorted(single, key=len, reverse=True)))
        found = F.concat(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?U)(?<!\w)(?:{either})(?!\w)"), F.lit(0))), found)
    return found


def quoted(keyword: str) -> str:
    """The keyword as a pattern that stands for itself."""
    return r"\Q" + keyword.replace(r"\E", r"\E\\E\Q") + r"\E"


def canonical_decimal(value: Column) -> Column:
    """Plain notation without trailing zeros."""
    plain = F.regexp_replace(value.cast("string"), r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(plain, r"\.$", "")


def canonical_json(fields: dict, ordered: bool = True) -> Column:
    """The fields as one line of JSON without blanks, by name unless ``ordered`` is false; nulls are written.

    Values are columns, or mappings of their own. Numbers that have to be the same however
    they are written are passed through ``canonical_decimal``.
    """

    def made(named: dict) -> Column:
        names = sorted(named) if ordered else list(named)
        return F.struct(*((made(named[n]) if isinstance(named[n], dict) else named[n]).alias(n) for n in names))

    return F.to_json(made(fields), {"ignoreNullFields": "false"})


def record_hash(fields: dict) -> Column:
    """SHA-256 of the canonical JSON of the fields, so neither their order nor trailing zeros of canonical decimals matter, and null isn't empty."""
    return F.sha2(canonical_json(fields), 256)


def composite_id(explicit: Column, *parts: Column) -> Column:
    return F.coalesce(explicit, F.concat_ws("|", *parts))


def lenient_decimal(text: Column, missing: tuple[str, ...] = ("", ".", "na", "n/a", "null", "-")) -> Column:
    """A number with thousands commas and quotes; missing markers and bad input are null."""
    bare = F.trim(F.regexp_replace(text, r"[,\"']", ""))
    return F.when(~F.lower(bare).isin(*missing), bare).try_cast("decimal(18,6)")


def true_flags(flags: dict[str, Column]) -> Column:
    """Names of the true flags, comma-joined in order; null if none."""
    return F.nullif(F.concat_ws(",", *(F.when(c, F.lit(n)) for n, c in flags.items())), F.lit(""))


def gdd_base(crop: Column) -> Column:
    """Base temperature of growing degree days."""
    return F.when(F.lower(crop).rlike("rapeseed|canola"), 5).otherwise(10)


def calendar_features(day: Column) -> dict[str, Column]:
    """Calendar columns of a date."""
    year_days = F.dayofyear(F.last_day(F.make_date(F.year(day), F.lit(12), F.lit(1))))
    turn = lambda part, whole: 2 * F.pi() * part / whole
    month = F.month(day)
    return {
        "calendar_year": F.year(day),
        "calendar_month": month,
        "calendar_quarter": F.quarter(day),
        "calendar_week_of_year": F.weekofyear(day),
        "calendar_day_of_year": F.dayofyear(day),
        "calendar_day_of_week": F.weekday(day) + 1,
        "calendar_is_month_start": F.dayofmonth(day) == 1,
        "calendar_is_month_end": F.last_day(day) == day,
        "calendar_is_quarter_start": (F.dayofmonth(day) == 1) & month.isin(1, 4, 7, 10),
        "calendar_is_quarter_end": (F.last_day(day) == day) & month.isin(3, 6, 9, 12),
        "calendar_sin_day_of_year": F.round(F.sin(turn(F.dayofyear(day), year_days)), 9),
        "calendar_cos_day_of_year": F.round(F.cos(turn(F.dayofyear(day), year_days)), 9),
        "calendar_sin_month": F.round(F.sin(turn(month, F.lit(12))), 9),
        "calendar_cos_month": F.round(F.cos(turn(month, F.lit(12))), 9),
        "calendar_season": F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("autumn"),
    }
