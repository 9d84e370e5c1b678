"""License scans by Dice coefficient over word bigrams, in SQL functions only (operator 5).

Every line of a text is normalised to lower-case words and compared with the notices'
bigram sets. A Dice coefficient of d needs set sizes within a factor (2 - d) / d of
each other, so only notices of fitting size are compared, and only lines that hold one
of the words (``signs``) without which none can reach it.

Notices that run over several lines, or stand in a longer one, are found by windows of
the text's words of all lengths that the size bound admits: at most (2 - d) / d times as
many word pairs as the notice has. No pair that isn't the notice's at a window's edge adds
to its coefficient, so the best window from each of the notice's pairs on is found by one
walk, wherever enough of the notice's pairs follow closely; none is missed.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Well-known notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "all-rights": "All rights reserved.",
}
# Whole licence texts.
TEMPLATES |= {
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
LEAST = 0.8
#: Notices from which a match must have more word pairs than this are looked for in longer lines only.
LONG_PAIRS = 32
#: Matches of a text that are told apart in one stretch before they are put together.
STRETCH = 256


def words(line: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(line), F.lit("[a-z0-9]+"), F.lit(0))


def bigrams(found: Column) -> Column:
    """Distinct neighbours; a single word stands for itself."""
    many = F.greatest(F.size(found) - 1, F.lit(0))
    # Zipped, since a lambda that looks into ``found`` would work it out again for every word.
    pairs = F.zip_with(F.slice(found, 1, many), F.slice(found, 2, many), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(found) == 1, found).otherwise(F.array_distinct(pairs))


def _unavoidable(n: int, least: float) -> int:
    """How many of a notice's ``n`` bigrams no match can be without all of."""
    return int(n * (1 - least / (2 - least)) + 1e-9) + 1


def signs(templates: dict[str, str], least: float) -> list[str]:
    """Words of which a line holds one if it matches any notice.

    A match has at least ``least / (2 - least)`` of the notice's bigrams, so it holds one of
    any set of bigrams larger than the rest; those of the longest words are taken.
    """
    found = set()
    for notice in templates.values():
        w = re.findall("[a-z0-9]+", notice.lower())
        longest = sorted((max(pair, key=len) for pair in {*itertools.pairwise(w)} or {(x,) for x in w}), key=lambda x: (-len(x), x))
        found.update(longest[: _unavoidable(len(longest), least)])
    return sorted(found)


@dataclass(frozen=True)
class _Notice:
    """A notice's distinct word pairs, in order, and what bounds its windows."""

    license: str
    pairs: tuple[str, ...]
    #: Pairs of the notice that every match holds at least.
    need: int
    #: Word pairs that a window has at most.
    most: int

    @property
    def unavoidable(self) -> list[str]:
        """Its longest pairs, as many as no match can be without all of."""
        chosen = sorted(self.pairs, key=lambda p: (-len(p), p))
        return chosen[: len(self.pairs) - self.need + 1]


def _notices(templates: dict[str, str], least: float) -> list[_Notice]:
    """The notices of two words or more; one of a single word is found as a line only."""
    found = []
    for name, notice in templates.items():
        w = re.findall("[a-z0-9]+", notice.lower())
        pairs = tuple(dict.fromkeys(f"{x} {y}" for x, y in itertools.pairwise(w)))
        if pairs:
            m = len(pairs)
            found.append(_Notice(name, pairs, m - _unavoidable(m, least) + 1, int(m * (2 - least) / least + 1e-9)))
    return found


def _pattern(pairs: list[str]) -> str:
    """A pattern of texts that hold one of the word pairs, by first letters so that few are tried at a place."""
    by_letter: dict[str, list[str]] = {}
    for p in sorted(pairs):
        by_letter.setdefault(p[0], []).append(p[1:].replace(" ", "[^a-z0-9]+"))
    return "(?<![a-z0-9])(?:" + "|".join(f"{x}(?:{'|'.join(rest)})" for x, rest in by_letter.items()) + ")(?![a-z0-9])"


def _listed(some: Iterable[str]) -> str:
    """An array of SQL literals: one expression to parse instead of one call for each."""
    return "array(" + ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in some) + ")"


def _literal(structs: list[dict[str, object]]) -> Column:
    """An array of structs of texts, arrays of texts and whole numbers."""
    sql = lambda v: str(v) if isinstance(v, int) else _listed([v])[6:-1] if isinstance(v, str) else _listed(v)
    return F.expr("array(" + ", ".join("named_struct(" + ", ".join(f"'{k}', {sql(v)}" for k, v in x.items()) + ")" for x in structs) + ")")


def _dice(grams: Column, size: Column, own: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(grams, own)) / (size + F.size(own))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_MATCH = "struct<license:string,line:bigint,dice:double>"
_CLOSE = "struct<k:int,start:int,last:int,dice:double>"


def _walk(pairs: Column, start: Column, note: Column) -> Column:
    """The end and the coefficient of the best window from ``start`` on, the shortest of equal ones."""
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), F.lit(0).alias("c"), F.lit(0).alias("at"), F.lit(0.0).alias("dice"))

    def along(some: Column) -> Column:
        # 2: a pair of the notice not met in the window before, 1: another one, 0: met before.
        told = F.transform(some, lambda x, i: F.when(F.array_position(some, x) != i + 1, 0).when(F.array_contains(note["grams"], x), 2).otherwise(1))

        def step(s: Column, x: Column) -> Column:
            n, c = s["n"] + F.when(x > 0, 1).otherwise(0), s["c"] + F.when(x == 2, 1).otherwise(0)
            dice = 2.0 * c / (note["size"] + n)
            better = (x == 2) & (dice > s["dice"])
            return F.struct((s["i"] + 1).alias("i"), n.alias("n"), c.alias("c"), F.when(better, s["i"]).otherwise(s["at"]).alias("at"), F.when(better, dice).otherwise(s["dice"]).alias("dice"))

        return F.aggregate(told, zero, step)

    return _bound(F.slice(pairs, start + 1, note["most"]), along)


def _apart(close: Column, notes: Column) -> Column:
    """Of windows sorted by notice and start, the best of the first ones, then the next after its end, and so on.

    The first ones are those that start so near to the first that all of them overlap.
    """
    none = F.array().cast(f"array<{_CLOSE}>")
    fields = ("k", "start", "last", "dice")

    def step(s: Column, x: Column) -> Column:
        best = s["best"]
        same = F.coalesce(x["k"] == best["k"], F.lit(False))
        beside = same & (x["start"] < s["until"])
        over = same & (x["start"] <= best["last"])
        fresh = ~(beside | over)
        taken = fresh | (beside & (x["dice"] > best["dice"]))
        return F.struct(
            F.when(taken, x).otherwise(best).alias("best"),
            F.when(fresh, x["start"] + F.get(notes, x["k"])["need"]).otherwise(s["until"]).alias("until"),
            F.when(fresh & best.isNotNull(), F.concat(s["out"], F.array(best))).otherwise(s["out"]).alias("out"),
        )

    def stretch(s: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(close, at + 1, STRETCH), F.struct(s["best"].alias("best"), s["until"].alias("until"), none.alias("out")), step)
        return _bound(inner, lambda r: F.struct(r["best"].alias("best"), r["until"].alias("until"), F.concat(s["out"], r["out"]).alias("out")))

    zero = F.struct(F.lit(None).cast(_CLOSE).alias("best"), F.lit(0).alias("until"), none.alias("out"))
    end = lambda s: F.transform(F.concat(s["out"], F.array(s["best"])), lambda x: F.struct(*(x[f].alias(f) for f in fields)))
    return F.when(F.size(close) > 0, F.aggregate(F.sequence(F.lit(0), F.size(close) - 1, F.lit(STRETCH)), zero, stretch, end)).otherwise(none)


def _windows(texts: DataFrame, notices: list[_Notice], least: float) -> DataFrame:
    """``texts`` (doc_id, text) with ``windows``: array of (license, line, dice), none overlapping another of its notice.

    A window that begins in a line which matches the notice by itself isn't named again.
    """
    by_pair: dict[str, list[int]] = {}
    for k, notice in enumerate(notices):
        for pair in notice.pairs:
            by_pair.setdefault(pair, []).append(k)
    notes = _literal([{"license": x.license, "grams": x.pairs, "size": len(x.pairs), "need": x.need, "most": x.most, "k": k} for k, x in enumerate(notices)])
    of_pair = F.expr("map(" + ", ".join(f"'{pair}', array({', '.join(map(str, some))})" for pair, some in by_pair.items()) + ")")
    told = F.transform(F.split("text", "\n"), lambda line, i: F.transform(words(line), lambda w, k: F.struct(w.alias("w"), i.cast("long").alias("line"), k.alias("at"))))
    sizes = F.transform(F.split("text", "\n"), lambda line: F.size(words(line)))
    signed = F.lower("text").rlike(_pattern(sorted({p for x in notices for p in x.unavoidable})))
    empty = lambda kind: F.array().cast(f"array<{kind}>")

    # Each array comes out of a generator, so that lambdas refer to plain columns.
    def keep(rows: DataFrame, name: str, value: Column) -> DataFrame:
        return rows.select("*", F.explode(F.array(value)).alias(name))

    rows = keep(texts, "ws", F.when(signed, F.flatten(told)).otherwise(empty("struct<w:string,line:bigint,at:int>")))
    rows = keep(rows, "sizes", F.when(F.size("ws") > 0, sizes).otherwise(empty("int")))
    rows = keep(rows, "ps", F.when(F.size("ws") > 1, F.zip_with(F.slice("ws", 1, F.size("ws") - 1), F.slice("ws", 2, F.size("ws") - 1), lambda a, b: F.concat_ws(" ", a["w"], b["w"]))).otherwise(empty("string")))
    places = F.when(F.size("ps") > 0, F.sequence(F.lit(0), F.size("ps") - 1)).otherwise(empty("int"))
    rows = keep(rows, "places", places)
    rows = keep(rows, "hits", F.expr(f"filter(places, p -> get(ps, p) IN ({_listed(by_pair)[6:-1]}))"))
    rows = keep(rows, "of", F.flatten(F.transform("hits", lambda p: F.transform(F.element_at(of_pair, F.get("ps", p)), lambda k: F.struct(k.alias("k"), p.alias("p"))))))

    def dense(note: Column) -> Column:
        own = F.transform(F.filter("of", lambda x: x["k"] == note["k"]), lambda x: x["p"])
        return _bound(own, lambda h: F.transform(F.filter(h, lambda p, i: F.get(h, i + note["need"] - 1) - p < note["most"]), lambda p: F.struct(note["k"].alias("k"), p.alias("p"))))

    rows = keep(rows, "starts", F.when(F.size("of") > 0, F.flatten(F.transform(notes, dense))).otherwise(empty("struct<k:int,p:int>")))
    walked = lambda s: _bound(
        _walk(F.col("ps"), s["p"], F.get(notes, s["k"])),
        lambda e: F.struct(s["k"].alias("k"), s["p"].alias("start"), (s["p"] + e["at"]).alias("last"), e["dice"].alias("dice")),
    )
    rows = keep(rows, "close", F.filter(F.transform("starts", walked), lambda m: m["dice"] >= least))
    rows = keep(rows, "apart", _apart(F.col("close"), notes))

    def own(m: Column) -> Column:
        first = F.get("ws", m["start"])
        return bigrams(F.transform(F.slice("ws", m["start"] - first["at"] + 1, F.get("sizes", first["line"].cast("int"))), lambda x: x["w"]))

    lone = F.filter("apart", lambda m: _dice(F.get(notes, m["k"])["grams"], F.get(notes, m["k"])["size"], own(m)) < least)
    shown = F.transform(lone, lambda m: F.struct(F.get(notes, m["k"])["license"].alias("license"), F.get("ws", m["start"])["line"].alias("line"), m["dice"].alias("dice")))
    return rows.select(*texts.columns, shown.alias("windows"))


def _worth(templates: dict[str, str], least: float) -> Column:
    """Whether a line's ``words`` may be like a notice: enough of them, and one of the signs; long notices by themselves."""
    tiers: dict[bool, dict[str, str]] = {}
    shortest: dict[bool, int] = {}
    for name, notice in templates.items():
        size = len({*itertools.pairwise(re.findall("[a-z0-9]+", notice.lower()))}) or 1
        # A line needs about as many words as the smallest notice has bigrams at least; this is the lower size bound.
        need = max(1, int(size * least / (2 - least)))
        tier = need > LONG_PAIRS
        tiers.setdefault(tier, {})[name] = notice
        shortest[tier] = min(shortest.get(tier, need), need)
    some = [(F.size("words") >= shortest[t]) & F.arrays_overlap("words", F.expr(_listed(signs(tier, least)))) for t, tier in sorted(tiers.items())]
    return functools.reduce(lambda a, b: a | b, some)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, line, license, dice) of every line, and every window of words, that is like a notice.

    Lines count from 0; a window is told by the line in which it begins. A line may match
    several notices and gives a row for each. Of a notice's windows the first, or the best
    of those that start so near to it that all overlap, is told, then the first after its
    end and so on: every window that matches starts where a told one, or one that overlaps
    a told one, does. Null and empty texts and lines without words match nothing. Repeated
    rows give their matches again.
    """
    templates = TEMPLATES if templates is None else templates
    stretch = (2 - least) / least + 1e-9
    notes = []
    for name, notice in templates.items():
        w = re.findall("[a-z0-9]+", notice.lower())
        grams = list(dict.fromkeys(f"{x} {y}" for x, y in itertools.pairwise(w))) or w
        notes.append({"license": name, "grams": grams, "size": len(grams)})
    known = _literal(notes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    notices = _notices(templates, least)
    texts = _windows(texts, notices, least) if notices else texts.withColumn("windows", F.array().cast(f"array<{_MATCH}>"))
    lines = texts.select("doc_id", "windows", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    first = F.when(F.col("line") == 0, F.col("windows")).otherwise(F.array().cast(f"array<{_MATCH}>"))
    lines = lines.select("doc_id", "line", first.alias("windows"), F.explode(F.array(words(F.col("text")))).alias("words"))
    lines = lines.filter(_worth(templates, least) | (F.size("windows") > 0))
    lines = lines.select("doc_id", "line", "windows", F.explode(F.array(F.when(F.size("words") > 0, bigrams(F.col("words"))).otherwise(F.array().cast("array<string>")))).alias("grams"))
    n = F.size("grams")
    fitting = F.filter(known, lambda t: (t["size"] <= n * stretch) & (n <= t["size"] * stretch))
    matches = F.transform(fitting, lambda t: F.struct(t["license"].alias("license"), F.col("line").cast("long").alias("line"), _dice(t["grams"], t["size"], F.col("grams")).alias("dice")))
    found = lines.select("doc_id", F.inline(F.concat(F.filter(matches, lambda m: m["dice"] >= least), F.col("windows"))))
    return found.select("doc_id", "line", "license", F.round("dice", 6).alias("dice"))


def oracle(templates: dict[str, str] | None = None, least: float = LEAST) -> str:
    """The same rows in DuckDB SQL: every line against every notice, and every window between two pairs of a notice."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in (templates or TEMPLATES).items())
    grams = lambda w: f"CASE WHEN len({w}) = 1 THEN {w} ELSE list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])) END"
    return f"""
WITH RECURSIVE notice(license, notice) AS (VALUES {values}),
known AS (SELECT license, {grams('w')} AS g, len(w) AS n_words FROM (SELECT license, regexp_extract_all(lower(notice), '[a-z0-9]+') AS w FROM notice)),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
cut AS (SELECT doc_id, line, {grams('w')} AS h FROM (SELECT doc_id, line, regexp_extract_all(lower(part), '[a-z0-9]+') AS w FROM lines) WHERE len(w) > 0),
met AS (SELECT doc_id, line, license, 2.0 * len(list_intersect(g, h)) / (len(g) + len(h)) AS dice FROM cut, known),
told AS (SELECT doc_id, line, unnest(w) AS word, generate_subscripts(w, 1) AS n FROM (SELECT doc_id, line, regexp_extract_all(lower(part), '[a-z0-9]+') AS w FROM lines) WHERE len(w) > 0),
placed AS (SELECT doc_id, line, word, row_number() OVER (PARTITION BY doc_id ORDER BY line, n) - 1 AS pos FROM told),
pairs AS (SELECT * FROM (SELECT doc_id, line, pos, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS pair FROM placed) WHERE pair IS NOT NULL),
sized AS (SELECT license, g, len(g) AS m, ceil(len(g) * {least} / (2 - {least}) - 1e-9) AS need, floor(len(g) * (2 - {least}) / {least} + 1e-9) AS most FROM known WHERE n_words > 1),
hit AS (SELECT doc_id, line, pos, pair, license, m, need, most FROM pairs JOIN (SELECT *, unnest(g) AS pair FROM sized) USING (pair)),
dense AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, license ORDER BY pos RANGE BETWEEN CURRENT ROW AND CAST(most - 1 AS BIGINT) FOLLOWING) AS near FROM hit) WHERE near >= need),
inside AS (SELECT d.doc_id, d.license, d.line, d.pos AS start, d.m, d.need, p.pos, p.pair, h.pos IS NOT NULL AS own
  FROM dense d JOIN pairs p ON p.doc_id = d.doc_id AND p.pos >= d.pos AND p.pos < d.pos + d.most
  LEFT JOIN hit h ON h.doc_id = d.doc_id AND h.license = d.license AND h.pos = p.pos),
fresh AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license, start, pair ORDER BY pos) = 1 AS new FROM inside),
summed AS (SELECT *, 2.0 * count(*) FILTER (new AND own) OVER w / (m + count(*) FILTER (new) OVER w) AS dice FROM fresh WINDOW w AS (PARTITION BY doc_id, license, start ORDER BY pos)),
close AS (SELECT doc_id, license, line, start, need, pos AS last, dice FROM summed WHERE own AND dice >= {least}
  QUALIFY row_number() OVER (PARTITION BY doc_id, license, start ORDER BY dice DESC, pos) = 1),
pick AS (SELECT a.doc_id, a.license, a.start AS first, b.line, b.last, b.dice FROM close a JOIN close b ON b.doc_id = a.doc_id AND b.license = a.license AND b.start >= a.start AND b.start < a.start + a.need
  QUALIFY row_number() OVER (PARTITION BY a.doc_id, a.license, a.start ORDER BY b.dice DESC, b.start) = 1),
step AS (SELECT p.doc_id, p.license, p.first, p.line, p.dice, min(c.start) AS next FROM pick p LEFT JOIN close c ON c.doc_id = p.doc_id AND c.license = p.license AND c.start > p.last GROUP BY ALL),
best AS (SELECT * FROM step WHERE (doc_id, license, first) IN (SELECT (doc_id, license, min(start)) FROM close GROUP BY doc_id, license)
  UNION ALL SELECT s.* FROM best b JOIN step s ON s.doc_id = b.doc_id AND s.license = b.license AND s.first = b.next),
every AS (SELECT doc_id, line, license, dice FROM met WHERE dice >= {least}
  UNION ALL SELECT doc_id, line, license, dice FROM best b WHERE NOT EXISTS (SELECT 1 FROM met m WHERE m.doc_id = b.doc_id AND m.line = b.line AND m.license = b.license AND m.dice >= {least}))
SELECT doc_id, CAST(line AS BIGINT) AS line, license, CAST(round(dice, 6) AS DOUBLE) AS dice FROM every"""
