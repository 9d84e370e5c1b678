"""Secret scans over a ledger of content-addressed blobs (operator 3).

Every version of every path is addressed by the SHA-256 of its text. The ledger holds
one row for each (blob, rule version) ever scanned. A scan takes only blobs that the
ledger lacks under the current rule version, each once however many paths hold it, and
joins the ledger's findings back to all paths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

# The base kinds in their order. Letters of the first stand for either case.
_ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")
# Kinds that the method adds; a whole match is a finding.
MORE = {
    "github": r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
    "url_login": r"(?<![A-Za-z0-9+.-])[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@",
}
KINDS = (*BASE, *MORE)
#: The fewest characters of a base kind's match, of an assignment's value.
FEWEST = {"assign": 12, "access": 18, "hex": 16}
#: Names the rules; part of the ledger's key, so changed rules scan every blob anew.
RULE_VERSION = hashlib.sha256(repr((_ASSIGN, _ACCESS, _HEX, FEWEST, MORE)).encode()).hexdigest()[:16]

Span = tuple[str, int, int]


@lru_cache(1)
def _compiled() -> dict[str, re.Pattern]:
    # A run of hex digits is skipped whole if it is short, so the length may stand in the pattern.
    rules = {"assign": re.compile(_ASSIGN, re.IGNORECASE | re.ASCII), "access": re.compile(_ACCESS), "hex": re.compile(rf"[0-9a-f]{{{FEWEST['hex']},}}+")}
    return rules | {kind: re.compile(rule) for kind, rule in MORE.items()}


def find_secrets(text: str) -> list[Span]:
    """(kind, start, end) in code points, by start and then kind; overlapping kinds all stay."""
    rules, found = _compiled(), []
    folded = text.lower() if text.isascii() else text
    if not text.isascii() or any(w in folded for w in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in rules["assign"].finditer(text) if m.end(1) - m.start(1) >= FEWEST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in rules["access"].finditer(text) if m.end() - m.start() >= FEWEST["access"]]
    found += [("hex", *m.span()) for m in rules["hex"].finditer(text)]
    for kind, sign in (("github", "gh"), ("slack", "xox"), ("jwt", "eyJ"), ("private_key", "-----BEGIN"), ("url_login", "://")):
        if sign in text:
            found += [(kind, *m.span()) for m in rules[kind].finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


LEDGER = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """Ledger rows of (blob, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = find_secrets(text)
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == kind for s in base) for kind in BASE]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((blob, RULE_VERSION, *counts, digest, _joined(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.string()] * 2 + [pa.int64()] * 3 + [pa.string()] * 2
            names = [part.split()[0] for part in LEDGER.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return blobs.select("blob", "text").mapInArrow(scan, LEDGER)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """The ledger's new rows, written: one for each text of ``versions`` that it lacks under the current rules; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    unseen = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    if ledger is not None:
        unseen = unseen.join(_current(ledger).select("blob").distinct(), "blob", "left_anti")
    return materialize(scan_blobs(unseen.dropDuplicates(["blob"])), "ledger")


def _current(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("rule_version") == RULE_VERSION)


def join_findings(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """``versions`` with the findings of their texts as struct ``finding``; ``ledger`` has one current row for each text."""
    finding = ledger.select("blob", F.struct(*ledger.columns).alias("finding"))
    addressed = versions.withColumn("__blob", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    joined = addressed.join(finding, addressed["__blob"] == finding["blob"])
    return joined.select(*(addressed[c] for c in versions.columns), "finding")


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Findings of every row of ``versions`` (text and anything else), and the ledger's new rows.

    Null texts count as empty ones. Equal texts are one blob and all their rows get its
    findings; the columns of ``versions`` stay, those of the ledger follow as a struct
    ``finding``. The new rows are written before they are joined; append them to the
    ledger. Rows of the ledger from other rule versions play no part.
    """
    new = scan_unseen(versions, ledger)
    # A ledger that was appended to twice for a blob still gives each path one finding.
    whole = new if ledger is None else new.unionByName(_current(ledger).select(new.columns)).dropDuplicates(["blob"])
    return join_findings(versions, whole), new


def scan_documents(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob) of every row of ``docs``."""
    found, _ = scan_versions(docs.select("doc_id", "text"), ledger)
    return _columns(found)


def _columns(found: DataFrame) -> DataFrame:
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob")
    return found.select(F.col("doc_id").cast("long"), *(F.col(f"finding.{n}").alias(n) for n in names))


def scan_deliveries(deliveries: list[DataFrame], ledger: DataFrame | None = None) -> DataFrame:
    """The ledger after ``deliveries`` of versions in their order, one row for each text.

    Each delivery meets the ledger that those before it left, so that a text which an
    earlier one held is scanned no more. ``ledger`` has one row for each text.
    """
    for versions in deliveries:
        new = scan_unseen(versions, ledger)
        ledger = new if ledger is None else _current(ledger).select(new.columns).unionByName(new)
    return ledger


def scan_in_two(docs: DataFrame) -> DataFrame:
    """As ``scan_documents``, by two deliveries: the rows up to the middle of the ids, then the others.

    The second scans only texts that the first left out of the ledger, whose findings
    are then joined to all rows. Rows without an id come with the second; a table without
    ids has an empty first delivery.
    """
    versions = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low, high = versions.agg(F.min("doc_id"), F.max("doc_id")).first()
    earlier = F.lit(False) if low is None else F.coalesce(F.col("doc_id") <= (low + high) // 2, F.lit(False))
    return _columns(join_findings(versions, scan_deliveries([versions.filter(earlier), versions.filter(~earlier)])))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced; texts without one and nulls stay."""
    text = docs.schema["text"].dataType

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("__spans")
            spans, texts = batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("text")).to_pylist()
            for i, found in enumerate(spans):
                if found:
                    texts[i] = _replaced(texts[i], found, mark)
            columns = [pa.array(texts, pa.string()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns[:at] + columns[at + 1 :], [n for n in batch.schema.names if n != "__spans"])

    found, _ = scan_versions(docs.withColumn("text", F.col("text").cast("string")))
    spans = found.select(*docs.columns, F.col("finding.spans").alias("__spans"))
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    hit = spans.filter("__spans <> ''").mapInArrow(clean, schema)
    return spans.filter("__spans = ''").drop("__spans").unionByName(hit).withColumn("text", F.col("text").cast(text))


def _replaced(text: str, spans: str, mark: str) -> str:
    out, at = [], 0
    for start, end in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(","))):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
