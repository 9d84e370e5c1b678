"""CSV payloads held in a column, read with built-in functions only.

Between quotes, commas and line ends belong to the field and a doubled quote is one
quote. Which characters lie between quotes follows from the number of quotes before them,
so delimiters there are masked, the text is split, and the fields are unmasked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A private character and the letters that stand after it for what it masks, itself first.
_MASK = "\ue000"
_MASKED = {_MASK: "a", ",": "b", "\n": "c", "\r": "d"}


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _field(raw: Column) -> Column:
    """What a masked field says: without its quotes, doubled ones once."""
    bare = F.trim(raw)
    quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1)
    said = F.when(quoted, F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))).otherwise(bare)
    return _swap(said, [(_MASK + code, c) for c, code in reversed(_MASKED.items())])


def balanced(payload: Column) -> Column:
    """Whether every quote is closed."""
    return F.size(F.split(payload, '"')) % 2 == 1


def records(payload: Column) -> Column:
    """The records of a CSV text as arrays of fields; a byte order mark and blank lines are dropped, fields trimmed unless quoted."""
    safe = F.replace(F.regexp_replace(payload, "^\ufeff", ""), F.lit(_MASK), F.lit(_MASK + _MASKED[_MASK]))
    inside = [(c, _MASK + code) for c, code in _MASKED.items() if c != _MASK]
    pieces = F.transform(F.split(safe, '"'), lambda s, i: F.when(i % 2 == 1, _swap(s, inside)).otherwise(s))
    lines = F.filter(F.split(F.array_join(pieces, '"'), r"\r?\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, lambda x: F.transform(F.split(x, ","), _field))


def header_key(name: Column) -> Column:
    """A column's name as it is looked for: lower case, blanks, hyphens and underscores alike."""
    return F.regexp_replace(F.lower(F.trim(name)), r"[\s_\-]+", "_")


def named_rows(payloads: DataFrame, keys: list[str], payload: str, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """(keys, row, names, unreadable) of each record after the header, fields by the first of their names that the header has.

    Names are compared as ``header_key`` gives them. Fields that a record or the header
    lacks are null. A payload without a header, with an open quote or without any of the
    names is ``unreadable``, one without records is not; both give one row whose ``row`` is null.
    """
    split = payloads.select(*keys, F.col(payload).alias("__p"), records(F.col(payload)).alias("__r"))
    head = F.transform(F.get("__r", 0), header_key)
    at = {n: F.coalesce(*(F.nullif(F.array_position(head, a), F.lit(0)) for a in aliases)).cast("int") for n, aliases in names.items()}
    found = F.coalesce(*at.values())
    bad = F.col("__p").isNull() | (F.size("__r") < 1) | ~balanced(F.col("__p")) | found.isNull()
    body = F.when(~bad, F.slice("__r", 2, F.greatest(F.size("__r") - 1, F.lit(0))))
    rows = split.select(*keys, bad.alias("unreadable"), *(c.alias(f"__at_{n}") for n, c in at.items()), F.posexplode_outer(body).alias("row", "__f"))
    return rows.select(*keys, "row", *(F.get("__f", F.col(f"__at_{n}") - 1).alias(n) for n in names), "unreadable")
