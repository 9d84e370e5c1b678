"""Personal data by patterns, checksums and context, in SQL functions only (operator 9).

Patterns propose spans. Numbers, dots and check digits confirm them: card numbers by
Luhn, IBANs by the remainder mod 97, address parts by range, phones by digit count.
Words near a confirmed span then move its score. The patterns use possessive loops, and
may start only where a run of their first class begins or the last match ended; both
leave the matches as they are and keep long runs linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds' patterns in their order, then the method's own.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
#: What a text must hold for the pattern to be worth a look.
_SIGNS = {"email": "@", "ip": ".", "phone": "+"}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?)?"
#: Words that speak for a kind, in lower case, and the score of a confirmed span with and without.
CONTEXT = {
    "email": "(?:mail|contact|write|reach|address)",
    "ip": "(?:ip|host|server|address|login)",
    "card": "(?:card|visa|credit|debit|payment|master|account)",
    "phone": "(?:phone|call|tel|mobile|fax|contact)",
    "iban": "(?:iban|bank|account|transfer)",
}
SCORES = {"email": (0.85, 0.95), "ip": (0.6, 0.8), "card": (0.8, 0.95), "phone": (0.6, 0.85), "iban": (0.85, 0.95)}
#: Characters before and after a span that are searched for such words.
NEAR = 40
#: Matches that are placed one after another; stretches are then moved to their place.
STRETCH = 256


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an IBAN's remainder is 1; blanks don't count."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48))
    rest = F.aggregate(values, F.lit(0), lambda r, v: F.pmod(r * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))
    return rest == 1


def _holds(kind: str, match: Column) -> Column:
    digits = F.length(_digits(match))
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": digits.between(16, 19) & luhn(_digits(match)),
        "phone": digits.between(8, 15),
        "iban": mod97(match),
    }[kind]


_PART = "size:int,head:string,tail:string"


def _ends(x: Column) -> list[Column]:
    return [F.length(x).alias("size"), F.left(x, F.lit(NEAR)).alias("head"), F.right(x, F.lit(NEAR)).alias("tail")]


def _matches(text: Column, kind: str) -> Column:
    """The pattern's matches (length, first and last characters, whether they hold); none where a sign of the kind is missing."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    found = F.transform(found, lambda m: F.struct(*_ends(m), _holds(kind, m).alias("holds")))
    return F.when(F.contains(text, F.lit(_SIGNS[kind])) if kind in _SIGNS else F.lit(True), found).otherwise(F.array().cast(f"array<struct<{_PART},holds:boolean>>"))


def _gaps(text: Column, kind: str) -> Column:
    """The texts between the matches, one more than these; none without a match."""
    found = F.transform(F.split(text, PATTERNS[kind], -1), lambda g: F.struct(*_ends(g)))
    return F.when(F.size(f"__{kind}") > 0, found).otherwise(F.array().cast(f"array<struct<{_PART}>>"))


def _scored(kind: str, gaps: Column, matches: Column) -> Column:
    """array<struct<gap, size, holds, score>> of the matches; both arrays must be plain columns.

    Words count that lie within ``NEAR`` characters of the match, on either side as far
    as the neighbouring match but one.
    """
    tail = lambda x: F.coalesce(x["tail"], F.lit(""))
    head = lambda x: F.coalesce(x["head"], F.lit(""))
    plain, backed = SCORES[kind]

    def one(m: Column, i: Column) -> Column:
        before = F.right(F.concat(tail(F.get(gaps, i - 1)), tail(F.get(matches, i - 1)), tail(F.get(gaps, i))), F.lit(NEAR))
        after = F.left(F.concat(head(F.get(gaps, i + 1)), head(F.get(matches, i + 1)), head(F.get(gaps, i + 2))), F.lit(NEAR))
        near = F.lower(F.concat_ws(" ", before, after)).rlike(rf"(?<![a-z]){CONTEXT[kind]}")
        score = F.when(m["holds"], F.when(near, backed).otherwise(plain))
        return F.struct(F.get(gaps, i)["size"].alias("gap"), m["size"].alias("size"), m["holds"].alias("holds"), score.alias("score"))

    return F.transform(matches, one)


_SPAN = "struct<start:int,end:int,score:double>"


def _stretches(scored: Column) -> Column:
    """The matches by stretches of ``STRETCH``: the characters of each, and its confirmed spans counted from its begin."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + m["size"]
        span = F.struct(start.alias("start"), end.alias("end"), m["score"].alias("score"))
        return F.struct(end.alias("at"), F.when(m["holds"], F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    firsts = F.when(F.size(scored) > 0, F.sequence(F.lit(1), F.size(scored), F.lit(STRETCH)))
    found = F.transform(firsts, lambda k: F.aggregate(F.slice(scored, k, STRETCH), begin, step))
    return F.coalesce(found, F.array().cast(f"array<struct<at:int,out:array<{_SPAN}>>>"))


def _starts(stretches: Column) -> Column:
    """The characters before each stretch, and before the end."""
    nothing = F.array(F.lit(0))
    return F.aggregate(stretches, nothing, lambda at, s: F.concat(at, F.array(F.element_at(at, -1) + s["at"])))


def _spans(kind: str, stretches: Column, starts: Column) -> Column:
    def moved(s: Column, k: Column) -> Column:
        at = F.get(starts, k)
        return F.transform(s["out"], lambda x: F.struct(F.lit(kind).alias("kind"), (x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["score"].alias("score")))

    return F.flatten(F.transform(stretches, moved))


def _held(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``rows`` with columns that are worked out once a row: nothing that comes out of a generator moves into a lambda."""
    return rows.select("*", F.inline(F.array(F.struct(*(v.alias(k) for k, v in values.items())))))


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: array<struct<kind, start, end, score>>, by kind as listed and then start.

    Places are code points, ends exclusive. A null text counts as empty and has none.
    Kinds are searched apart, so one place may hold several. Other columns stay, save
    that one called ``pii`` gives way. The work grows with the text and its matches,
    also under a filter on the result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = _held(docs, {f"__{k}": _matches(text, k) for k in PATTERNS})
    held = _held(held, {f"__{k}_gaps": _gaps(text, k) for k in PATTERNS})
    held = _held(held, {f"__{k}_scored": _scored(k, F.col(f"__{k}_gaps"), F.col(f"__{k}")) for k in PATTERNS})
    held = held.drop(*(f"__{k}{part}" for k in PATTERNS for part in ("", "_gaps")))
    held = _held(held, {f"__{k}_parts": _stretches(F.col(f"__{k}_scored")) for k in PATTERNS}).drop(*(f"__{k}_scored" for k in PATTERNS))
    held = _held(held, {f"__{k}_starts": _starts(F.col(f"__{k}_parts")) for k in PATTERNS})
    spans = F.concat(*(_spans(k, F.col(f"__{k}_parts"), F.col(f"__{k}_starts")) for k in PATTERNS))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    return _held(held.select(*kept, spans.alias("__pii")), {"pii": F.col("__pii")}).drop("__pii")


def summarize(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of every row of ``docs``."""
    found = find_pii(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind in BASE),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
