"""Parsers over tables of landed payloads: one output row per record, built-ins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import ingest as I
from tidemark.sources import csvtext as C

# What counts as no value in CSV payloads.
MISSING = ("", ".", "na", "n/a", "null", "-")


def payload_kind(payload: Column) -> Column:
    """zip, html, json_rows, json_metadata, json, csv or unknown, from the payload's beginning."""
    head = F.lower(F.ltrim(F.substring(payload, 1, 1024)))
    rows = head.rlike(r'^\s*\[|"(data|dataset|rows|results|items|observations)"\s*:\s*\[')
    return (
        F.when(payload.startswith("PK"), "zip").when(head.startswith("<!doctype html") | head.startswith("<html"), "html").when(head.startswith("<"), "xml")
        .when((head.startswith("{") | head.startswith("[")) & rows, "json_rows").when(head.startswith("{"), "json_metadata")
        .when(head.rlike(r"^[^\n]*,[^\n]*(\n|$)"), "csv").otherwise("unknown")
    )


def parse_series_csv(payloads: DataFrame, key: str, payload: str, dates: tuple[str, ...], value: str, first: str, last: str) -> DataFrame:
    """(key, day, value, failed) of CSV payloads with a header.

    The date column is the first of ``dates`` that the header has. Rows with a missing
    marker or out of range drop out; one bad date, or one bad number in range, fails the
    whole payload, as a lacking column or an open quote does. It then gives a single row
    with ``failed`` true; one without rows gives a single row of nulls.
    """
    rows = C.named_rows(payloads, [key], payload, {"__day": dates, "__value": (value,)})
    head = F.get(C.records(F.col(payload)), 0)
    lacks = ~F.exists(head, lambda h: C.header_key(h) == value) | ~F.exists(head, lambda h: C.header_key(h).isin(*dates))
    lacking = payloads.select(F.col(key).alias("__key"), F.coalesce(lacks, F.lit(True)).alias("__lacks")).groupBy("__key").agg(F.bool_or("__lacks").alias("__lacks"))
    day, text = F.try_to_date(F.trim("__day"), "yyyy-MM-dd"), F.trim(F.coalesce("__value", F.lit("")))
    parsed = rows.select(key, "row", "unreadable", day.alias("day"), F.lower(text).isin(*MISSING).alias("gone"), S.lenient_decimal(text).alias("value"))
    inside = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    bad = F.col("unreadable") | F.col("row").isNotNull() & (F.col("day").isNull() | inside & ~F.col("gone") & F.col("value").isNull())
    fails = parsed.groupBy(key).agg(F.bool_or(bad).alias("failed"))
    fails = fails.join(lacking, fails[key].eqNullSafe(F.col("__key"))).select(key, (F.col("failed") | F.col("__lacks")).alias("failed"))
    good = parsed.filter(~F.col("gone") & inside).select(F.col(key).alias("__key"), "day", "value")
    return fails.join(good, fails[key].eqNullSafe(F.col("__key")) & ~F.col("failed"), "left").select(key, "day", "value", "failed")


# Where bars may lie in a payload, what their fields may be called, by shape, and how dates are written.
BAR_LISTS = ("data", "rows", "list", "items", "kline", "klines")
CODED_BAR = {"time": ("time",), "open": ("q1",), "close": ("q2",), "high": ("q3",), "low": ("q4",), "volume": ("q60",)}
NAMED_BAR = {"time": ("day", "date", "time"), "open": ("open", "o"), "high": ("high", "h"), "low": ("low", "l"), "close": ("close", "c", "price"), "volume": ("volume", "vol")}
LISTED_BAR = {"time": (0,), "open": (1,), "high": (2,), "low": (3,), "close": (4,), "volume": (9, 5)}
BAR_DATES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd")


def script_body(payload: Column) -> Column:
    """A payload without ``var x =`` before it and the semicolon after it."""
    return F.regexp_replace(F.regexp_replace(payload, r"^\s*(?:var\s+)?\w+\s*=\s*", ""), r"\s*;\s*$", "")


def parse_bars(payloads: DataFrame, key: str, payload: str, code: str | None = None, last: int | None = None) -> DataFrame:
    """(key, day, open, high, low, close, volume, failed) of each bar of JSON payloads, ``var x =`` before them or not.

    Bars are the first list found: under ``code``'s value in ``data``, the payload itself,
    under one of ``BAR_LISTS``, or of those within another. Each is an object of coded or
    named fields, or a list of numbers. The price of an object without others closes it.
    ``last`` keeps the last so many of a payload. Days are dates in several forms, or
    milliseconds. A payload in which no list of rows is found gives one row with ``failed`` true.
    """
    doc = F.try_parse_json(script_body(F.col(payload)))
    lists = [F.element_at(F.try_variant_get(F.col("__doc"), "$.data", "map<string,variant>"), F.col(code)).try_cast("array<variant>")] if code else []
    paths = ["$", *(f"$.{a}" for a in BAR_LISTS), *(f"$.{a}.{b}" for a in BAR_LISTS for b in BAR_LISTS)]
    lists += [F.try_variant_get(F.col("__doc"), p, "array<variant>") for p in paths]
    some = [F.when(F.size(x) > 0, x) for x in lists]
    found = payloads.select(key, *([code] if code and code != key else []), doc.alias("__doc")).select(key, F.coalesce(*some).alias("__bars"))
    kept = F.slice("__bars", F.greatest(F.size("__bars") - last + 1, F.lit(1)), last) if last else F.col("__bars")
    rows = found.select(key, F.posexplode_outer(kept).alias("__pos", "__bar"))

    def field(name: str) -> Column:
        text = lambda path: F.nullif(F.trim(F.try_variant_get("__bar", path, "string")), F.lit(""))
        return F.coalesce(*(text(f"$.{n}") for n in (*CODED_BAR[name], *NAMED_BAR[name])), *(text(f"$[{n}]") for n in LISTED_BAR[name]))

    said = rows.select(key, "__pos", *(field(n).alias(n) for n in ("time", "open", "high", "low", "close", "volume")))
    number = lambda n: F.replace(F.col(n), F.lit(","), F.lit(".")).try_cast("double")
    millis = F.when(F.col("time").rlike("^[0-9]{12,}$|^[0-9]{9,}[.][0-9]*$|^[0-9.]+E[0-9]+$"), F.col("time").try_cast("double"))
    written = F.coalesce(*(F.try_to_timestamp(F.left("time", F.lit(len(f))), F.lit(f)) for f in BAR_DATES))
    day = F.coalesce(F.date_from_unix_date(F.floor(millis / 86_400_000).cast("int")), F.to_date(written))
    prices = [number(n).alias(n) for n in ("open", "high", "low", "close", "volume")]
    return said.select(key, day.alias("day"), *prices, F.col("__pos").isNull().alias("failed"))


def sheet_cells(sheets: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, row, column, text) of every cell of sheets landed as CSV, rows and columns from 0."""
    rows = sheets.select(key, F.posexplode(C.records(F.col(payload))).alias("row", "__cells"))
    return rows.select(key, "row", F.posexplode("__cells").alias("column", "text"))


def sheet_series(sheets: DataFrame, key: str, payload: str, candidates: dict[str, tuple[str, ...]], first_rows: int = 12) -> DataFrame:
    """(key, series, period, period_end, value) of wide monthly sheets whose headers have to be found.

    Of each series of ``candidates`` the column is the first cell of the first ``first_rows``
    rows, by row and column, whose text is one of its names, stars and blanks aside. The
    first column holds the months (``1996M03`` or dates); rows without one, and cells
    without a number, are left out. A series that is nowhere found gives one row without a period.
    """
    cells = sheet_cells(sheets, key, payload)
    clean = F.lower(F.trim(F.regexp_replace(F.replace("text", F.lit("*"), F.lit("")), r"\s+", " ")))
    names = F.create_map(*(F.lit(x) for series, texts in candidates.items() for t in texts for x in (" ".join(t.replace("*", "").lower().split()), series)))
    heads = cells.filter(F.col("row") < first_rows).withColumn("series", F.try_element_at(names, clean)).filter("series is not null")
    places = heads.groupBy(key, "series").agg(F.min(F.struct("row", "column")).alias("__at")).select(key, "series", F.col("__at.column").alias("column"))
    month = F.upper(F.trim("text"))
    period = F.coalesce(F.try_to_date(F.regexp_replace(month, "^([0-9]{4})M([0-9]{2})$", "$1-$2-01"), "yyyy-MM-dd"), F.try_to_date(F.left(month, F.lit(10)), "yyyy-MM-dd"))
    months = cells.filter("column = 0").select(key, "row", F.trunc(period, "month").alias("period")).filter("period is not null")
    values = cells.select(key, "row", "column", S.lenient_decimal(F.col("text")).alias("value")).filter("value is not null")
    every = sheets.select(key).distinct().select(key, F.explode(F.array(*map(F.lit, candidates))).alias("series"))
    found = every.join(places, [key, "series"], "left")
    rows = found.join(values, [key, "column"], "left").join(months, [key, "row"], "left")
    lost = F.col("column").isNull()
    return rows.filter(lost | F.col("period").isNotNull()).select(key, "series", "period", F.last_day("period").alias("period_end"), "value")


def payload_validity(payloads: DataFrame, keys: list[str], payload: str, mime: str, kind: str, mimes: tuple[str, ...], most: int, prefix: str, code: str, path: str, index: int) -> DataFrame:
    """(keys, check_name, status, severity): eight checks of every payload, each of them once.

    ``kind`` names the column that says json, csv or xml. What is read are a JSON number at
    ``path``, the CSV field ``index`` of the first record, or an XML element ``value``; ``code`` names the
    column with what has to be a name or value in it. A payload that isn't readable fails
    all checks of its contents.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    body = F.when(text.startswith(prefix), F.regexp_replace(F.substring(text, F.lit(len(prefix) + 1), F.length(text)), r"\s*;\s*$", ""))
    json, record = F.try_parse_json(F.col("__body")), F.get(C.records(F.col("__body")), 0)
    xml = F.from_xml(F.col("__body"), "code string, value string, __bad string", {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"})
    is_ = lambda k: F.col(kind) == k
    held = payloads.withColumn("__text", text).withColumn("__body", body).withColumns({
        "__json": F.when(is_("json"), json), "__csv": F.when(is_("csv") & C.balanced(F.col("__body")), record), "__xml": F.when(is_("xml"), xml),
    })
    good_xml = F.col("__xml").isNotNull() & F.col("__xml.__bad").isNull() & (F.col("__xml.code").isNotNull() | F.col("__xml.value").isNotNull())
    parsed = F.when(is_("json"), F.col("__json").isNotNull()).when(is_("csv"), F.size("__csv") > 1).otherwise(good_xml)
    said = F.when(is_("json"), F.try_variant_get("__json", path, "string")).when(is_("csv"), F.get("__csv", index)).otherwise(F.col("__xml.value"))
    has = F.when(is_("json"), F.map_contains_key(F.try_variant_get("__json", "$", "map<string,variant>"), F.col(code))).when(is_("csv"), F.array_contains("__csv", F.col(code))).otherwise(F.col("__xml.code") == F.col(code))
    media = F.lower(F.trim(F.split_part(F.col(mime), F.lit(";"), F.lit(1))))
    rules = {
        "payload_non_empty": (F.length("__text") > 0, "error"), "content_type_expected": (media.isin(*mimes), "warning"), "size_within_limit": (F.octet_length("__text") <= most, "warning"),
        "prefix_found": (F.col("__body").isNotNull(), "error"), "parseable": (parsed, "error"), "code_present": (parsed & has, "error"),
        "value_present": (parsed & (said != ""), "error"), "value_convertible": (parsed & S.lenient_decimal(said).isNotNull(), "error"),
    }
    return I.row_checks(held, keys, rules)


_VALUTES = "`_Date` string, Valute array<struct<CharCode:string,Nominal:string,Value:string>>"


def parse_fx_xml(payloads: DataFrame, payload: str) -> DataFrame:
    """(day, code, rate) from an XML of valutes with decimal commas; rate is per one unit."""
    doc = payloads.select(F.from_xml(F.col(payload), _VALUTES).alias("x"))
    rows = doc.select(F.try_to_date(F.col("x._Date"), "dd.MM.yyyy").alias("day"), F.inline("x.Valute"))
    number = lambda c: F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double")
    return rows.select("day", F.col("CharCode").alias("code"), F.round(F.try_divide(number("Value"), number("Nominal")), 6).alias("rate"))


def missing_currencies(payloads: DataFrame, keys: list[str], payload: str, wanted: list[str]) -> DataFrame:
    """(keys, day, missing) of every XML of valutes: the ``wanted`` codes, sorted, without a rate that is a number; null if none lacks.

    A code counts with any rate above 0 under it. A payload that can't be read has no day and lacks all.
    """
    doc = payloads.select(*keys, F.from_xml(F.col(payload), _VALUTES).alias("x"))
    number = lambda text: F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    rated = F.filter("x.Valute", lambda v: F.try_divide(number(v["Value"]), number(v["Nominal"])) > 0)
    held = F.coalesce(F.transform(rated, lambda v: v["CharCode"]), F.array().cast("array<string>"))
    lacking = F.array_except(F.array(*map(F.lit, sorted(set(wanted)))), held)
    return doc.select(*keys, F.try_to_date(F.col("x._Date"), "dd.MM.yyyy").alias("day"), F.nullif(F.array_join(lacking, ","), F.lit("")).alias("missing"))


def zip_arrays(rows: DataFrame, key: list[str], times: str, arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays as one row per time; short arrays give nulls and are named in ``missing``."""
    short = F.concat_ws(",", *(F.when(F.coalesce(F.size(a), F.lit(0)) < F.size(times), F.lit(n)) for n, a in arrays.items()))
    long = rows.select(*key, *arrays.values(), short.alias("missing"), F.posexplode(times).alias("pos", "time"))
    return long.select(*key, "pos", "time", *(F.get(a, F.col("pos")).alias(n) for n, a in arrays.items()), "missing")


# Where JSON payloads hold their rows, the names that a field may have, in order, and how dates are written.
TRADE_ROWS = ("data", "dataset", "results", "items")
ARTICLE_ROWS = ("articles", "documents", "items")
BALANCE_ROWS = ("data", "rows", "results", "items")
TRADE_FIELDS = {
    "period": ("period", "periodDesc", "refPeriodId"),
    "quantity": ("qty", "quantity", "primaryQuantity", "qtyValue"),
    "value": ("primaryValue", "tradeValue", "tradeValueUsd", "fobvalue", "cifvalue"),
    "net_weight_kg": ("netWgt", "netWeight", "netWeightKg"),
    "gross_weight_kg": ("grossWgt", "grossWeight", "grossWeightKg"),
    "unit_value": ("unitValue", "unitValueUsd"),
}
ARTICLE_URLS = ("url", "URL")
ARTICLE_TITLES = ("title", "Title")
ARTICLE_SOURCES = ("sourceCommonName", "source_name", "source", "domain")
ARTICLE_DATES = ("seendate", "date", "datetime", "published_at", "publishedAt")
DATE_FORMATS = ("yyyyMMdd'T'HHmmss'Z'", "yyyyMMddHHmmss", "yyyyMMdd")
ESTIMATES = {"actual": "actual", "estimate": "estimate", "estimated": "estimate", "forecast": "forecast", "projection": "projection", "projected": "projection"}


def _rows_of(payload: Column, names: tuple[str, ...]) -> Column:
    """The array of variants under the first of the names that holds one, or the payload itself if it is an array."""
    doc = F.try_parse_json(payload)
    found = [F.try_variant_get(doc, f"$.{n}", "array<variant>") for n in names]
    return F.coalesce(*found, F.try_variant_get(doc, "$", "array<variant>"))


def _field(row: Column, names: tuple[str, ...]) -> Column:
    """The first of the fields that is there and not blank, as text."""
    return F.coalesce(*(F.nullif(F.trim(F.try_variant_get(row, f"$.{n}", "string")), F.lit("")) for n in names))


def parse_trade_json(payloads: DataFrame, keys: list[str], payload: str, more: dict[str, tuple[str, ...]] | None = None, default_period: Column | None = None) -> DataFrame:
    """(keys, pos, the fields of ``TRADE_FIELDS`` and ``more``, malformed) of each row of JSON trade payloads.

    Periods are yyyyMM or yyyy-MM and give a first day; a row without one has that of
    ``default_period``, a column of ``payloads``. A unit value that is missing is the value
    by the quantity, null where that is 0. ``more`` names further fields, read as text. A
    row that is no object, or whose period is none, is ``malformed``, as is (with pos null)
    a payload without rows.
    """
    default = F.lit(None).cast("string") if default_period is None else default_period
    # A row's fields are read once, in the generator, so that no filter on the result reads them again.
    objects = F.transform(_rows_of(F.col(payload), TRADE_ROWS), lambda row: F.try_variant_get(row, "$", "map<string,string>"))
    rows = payloads.select(*keys, default.alias("__default"), F.posexplode_outer(objects).alias("pos", "row"))
    field = lambda names: F.coalesce(*(F.nullif(F.trim(F.try_element_at("row", F.lit(n))), F.lit("")) for n in names))
    text = rows.select(*keys, "pos", "__default", F.col("row").isNotNull().alias("__object"), *(field(names).alias(n) for n, names in (TRADE_FIELDS | (more or {})).items()))
    number = lambda n: F.col(n).try_cast("double")
    said = F.coalesce("period", "__default")
    period = F.try_to_date(F.concat(F.regexp_extract(said, "^([0-9]{4})-?([0-9]{2})$", 1), F.lit("-"), F.regexp_extract(said, "^([0-9]{4})-?([0-9]{2})$", 2), F.lit("-01")), "yyyy-MM-dd")
    unit = F.coalesce(number("unit_value"), F.try_divide(number("value"), number("quantity")))
    numbers = [number(n).alias(n) for n in ("quantity", "value", "net_weight_kg", "gross_weight_kg")]
    out = text.select(*keys, "pos", *(more or {}), period.alias("period"), *numbers, unit.alias("unit_value"), "__object")
    return out.withColumn("malformed", ~F.col("__object") | F.col("__object").isNull() | F.col("period").isNull()).drop("__object")


def _moment(text: Column) -> Column:
    """A time in one of ``DATE_FORMATS``, or as ISO 8601 writes them; without a zone it is UTC."""
    stamps = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"), text).try_cast("timestamp")
    return F.coalesce(*stamps, iso).cast("timestamp_ntz")


def parse_article_json(payloads: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """(keys, pos, url, title, published_at, source_name, malformed) of each article of JSON payloads.

    The date is the first of ``ARTICLE_DATES`` that reads as a time. A source without a
    name is called by its host, or unknown. Without address, title or date an article is
    ``malformed``, as is (with pos null) a payload without articles.
    """
    rows = payloads.select(*keys, F.posexplode_outer(_rows_of(F.col(payload), ARTICLE_ROWS)).alias("pos", "row"))
    field = lambda *names: _field(F.col("row"), names)
    at = F.coalesce(*(_moment(field(n)) for n in ARTICLE_DATES))
    text = rows.select(*keys, "pos", field(*ARTICLE_URLS).alias("url"), field(*ARTICLE_TITLES).alias("title"), at.alias("published_at"), field(*ARTICLE_SOURCES).alias("name"))
    host = F.lower(F.regexp_extract("url", r"^[^:]+://([^/?#:]*)", 1))
    out = text.withColumn("source_name", F.coalesce("name", F.nullif(host, F.lit("")), F.lit("unknown"))).drop("name")
    return out.withColumn("malformed", F.col("url").isNull() | F.col("title").isNull() | F.col("published_at").isNull())


#: Names of the fields of balances in headers, as ``csvtext.header_key`` writes them, and in JSON rows.
BALANCE_FIELDS = {
    "country": ("country_name", "country"), "metric": ("metric_name", "metric", "attribute", "attribute_name", "attribute_description"),
    "year": ("marketing_year", "market_year"), "month": ("report_month", "month"), "estimate": ("estimate_type",), "value": ("metric_value", "value", "amount"),
}


def parse_balances(payloads: DataFrame, keys: list[str], payload: str, metrics: dict[str, str], countries: tuple[str, ...], years: tuple[int, int], fetched: Column | None = None) -> DataFrame:
    """(keys, country, metric, marketing_year, report_month, estimate_type, value, year_start, year_end, route) of each row of CSV or JSON payloads.

    Headers may be written with blanks, hyphens or underscores; JSON rows lie in a list or
    under one of ``BALANCE_ROWS``. ``metrics`` maps names to codes; rows of other metrics,
    countries or years are ``skipped``, rows whose year or value is no number, and payloads
    that can't be read (without fields), ``malformed``, the others ``parsed``. A row without
    a month has that of ``fetched``; an estimate type that isn't known is unknown. A
    marketing year runs from January to December.
    """
    names, when = list(BALANCE_FIELDS), F.lit(None).cast("date") if fetched is None else fetched
    is_json = F.coalesce(F.col("__payload").rlike(r"^\s*[\[{]"), F.lit(False))
    held = payloads.select(*keys, F.col(payload).alias("__payload"), F.month(when).alias("__fetched"))
    csv = C.named_rows(held.filter(~is_json), [*keys, "__fetched"], "__payload", BALANCE_FIELDS).filter("row is not null or unreadable").drop("row", "unreadable")
    json = held.filter(is_json).select(*keys, "__fetched", F.explode_outer(_rows_of(F.col("__payload"), BALANCE_ROWS)).alias("__row"))
    text = csv.unionByName(json.select(*keys, "__fetched", *(_field(F.col("__row"), BALANCE_FIELDS[n]).alias(n) for n in names)))
    code = F.try_element_at(F.create_map(*(F.lit(x) for kv in metrics.items() for x in kv)), F.lower("metric"))
    kind = F.try_element_at(F.create_map(*(F.lit(x) for kv in ESTIMATES.items() for x in kv)), F.lower(F.trim("estimate")))
    typed = text.select(
        *keys, "country", code.alias("metric"), F.col("year").try_cast("int").alias("marketing_year"), F.coalesce(F.col("month").try_cast("int"), "__fetched").alias("report_month"),
        F.coalesce(kind, F.lit("unknown")).alias("estimate_type"), S.lenient_decimal(F.col("value")).cast("double").alias("value"),
    )
    bad = F.col("marketing_year").isNull() | F.col("value").isNull()
    out = F.col("metric").isNull() | F.coalesce(~F.col("country").isin(*countries), F.lit(True)) | ~F.col("marketing_year").between(*years)
    year = lambda m, d: F.make_date("marketing_year", F.lit(m), F.lit(d))
    return typed.select("*", year(1, 1).alias("year_start"), year(12, 31).alias("year_end"), F.when(bad, "malformed").when(out, "skipped").otherwise("parsed").alias("route"))


def parse_quotes(payloads: DataFrame, instrument: str, payload: str, paths: dict[str, str | int]) -> DataFrame:
    """``payloads`` with ``price``: by instrument the number at a JSON path, or of a CSV field counted from 0.

    A leading ``var x =`` and a closing semicolon are dropped. Unknown instruments and
    what is no number have no price.
    """
    body = script_body(F.col(payload))
    price = F.lit(None).cast("string")
    for name, path in paths.items():
        at = F.trim(F.get(F.get(C.records(F.regexp_replace(body, '^"|"$', "")), 0), F.lit(path))) if isinstance(path, int) else F.try_variant_get(F.try_parse_json(body), path, "string")
        price = F.when(F.col(instrument) == name, at).otherwise(price)
    return payloads.withColumn("price", price.try_cast("decimal(18,6)"))


def unpivot_series(rows: DataFrame, ids: list[str], headers: dict[str, str], name: str = "series", value: str = "value") -> DataFrame:
    """A wide sheet as a long series; ``headers`` maps columns to series names."""
    renamed = rows.select(*ids, *(F.col(c).cast("double").alias(n) for c, n in headers.items()))
    return renamed.unpivot(ids, list(headers.values()), name, value).filter(F.col(value).isNotNull())


#: Keys under which a document of observations holds its list.
OBSERVATION_ROWS = ("observations", "inventory")


def load_json_observations(payloads: DataFrame, keys: list[str], payload: str, required: list[str], dates: list[str], numbers: list[str] = (), upper: list[str] = ()) -> DataFrame:
    """(keys, pos, the fields, problem) of each observation of JSON documents: a list, or an object that holds one.

    An object's ``observations`` go before its ``inventory``, also where they are no list.
    ``required`` fields are trimmed texts, those in ``upper`` in upper case; ``dates`` have
    to be yyyy-MM-dd, ``numbers`` decimals of 6 digits. ``problem`` is null for an observation
    that can be used, else the first of: ``payload`` (unreadable or without a list, then
    with pos null), ``no object``, ``missing`` and the fields that lack or are blank, ``date``
    or ``number`` and the fields that are none. Nothing is left out; an empty list gives no row.
    """
    doc = F.try_parse_json(payload)
    first, second = (F.try_variant_get(doc, f"$.{n}", "variant") for n in OBSERVATION_ROWS)
    held = F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.coalesce(first, second)).otherwise(doc)
    listed = payloads.select(*keys, F.try_variant_get(held, "$", "array<variant>").alias("__list"))
    rows = listed.filter("__list is null or size(__list) > 0").select(*keys, F.posexplode_outer("__list").alias("pos", "row"))
    text = lambda n: F.nullif(F.trim(F.try_variant_get("row", f"$.{n}", "string")), F.lit(""))
    fields = list(dict.fromkeys([*required, *dates, *numbers]))
    object_ = F.try_variant_get("row", "$", "map<string,variant>").isNotNull()
    read = rows.select(*keys, "pos", F.coalesce(object_, F.lit(False)).alias("__object"), *((F.upper(text(n)) if n in upper else text(n)).alias(n) for n in fields))
    day = lambda n: F.when(F.col(n).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(F.col(n), "yyyy-MM-dd"))
    amount = lambda n: F.col(n).try_cast("decimal(38,6)")
    of = lambda what, some, bad: F.when(F.array_size(F.array_compact(F.array(*(F.when(bad(n), F.lit(n)) for n in some)))) > 0, F.concat(F.lit(f"{what}: "), F.concat_ws(",", *(F.when(bad(n), F.lit(n)) for n in some))))
    problems = [F.when(F.col("pos").isNull(), "payload"), F.when(~F.col("__object"), "no object"), of("missing", fields, lambda n: F.col(n).isNull())]
    problems += [of(what, some, lambda n, p=parsed: p(n).isNull()) for what, some, parsed in (("date", dates, day), ("number", numbers, amount)) if some]
    typed = [(day(n) if n in dates else amount(n) if n in numbers else F.col(n)).alias(n) for n in fields]
    return read.select(*keys, "pos", *typed, F.coalesce(*problems).alias("problem"))
