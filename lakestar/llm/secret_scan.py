"""Secret scans: known patterns plus sliding-window Shannon entropy.

The base kinds are fixed patterns. The kind ``entropy`` looks at candidate
strings (long runs of key characters): a window slides over each, the
entropy of its characters is kept up to date by the one character that
enters and the one that leaves, and windows above the limit of their
character class make a span unless an allow-list rule suppresses them.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# The base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CUES = ("passw", "secret", "token", "api")  # one of them is in every assignment
KINDS = ("assign", "access", "hex", "entropy")

RUN = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Character classes, narrowest first, with the least entropy in bits a character of a 20-character window.
CLASSES = ((re.compile(r"[0-9a-fA-F]+"), 3.0), (re.compile(r"[A-Z0-9]+"), 3.4),
           (re.compile(r"[A-Za-z0-9]+"), 3.7), (re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9))
#: Allow-list: strings that look random and are no secrets.
ALLOWED = (
    re.compile(r"[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]*"),  # words, also joined ones
    re.compile(r"[0-9]+([-_/=+][0-9]+)*"),  # numbers
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUIDs
    re.compile(r"[-_=+/]*"),  # rulers
    re.compile(r"([A-Za-z]+[0-9]{0,4}|[0-9]{1,4})([-_/=+]([A-Za-z]+[0-9]{0,4}|[0-9]{1,4}))+"),  # names, paths, slugs
)
KEY_BYTES = np.zeros(256, bool)
KEY_BYTES[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", "u1")] = True
NLOGN = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def has_run(raw: bytes, least: int) -> bool:
    """Whether ``least`` key characters stand in a row anywhere."""
    stops = np.flatnonzero(~KEY_BYTES[np.frombuffer(raw, "u1")])
    if not len(stops):
        return len(raw) >= least
    return bool(stops[0] >= least or len(raw) - 1 - stops[-1] >= least or (np.diff(stops) > least).any())


def hot_windows(s: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of the windows whose entropy is ``least`` bits or more and
    that hold both a letter and a digit. The sum of n log n over the window's
    character counts changes by two characters a step."""
    count: dict[str, int] = {}
    total, digits, letters, spans = 0.0, 0, 0, []
    for i, c in enumerate(s):
        n = count.get(c, 0)
        total += NLOGN[n + 1] - NLOGN[n]
        count[c] = n + 1
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= window:
            out = s[i - window]
            n = count[out]
            total += NLOGN[n - 1] - NLOGN[n]
            count[out] = n - 1
            digits -= out.isdigit()
            letters -= out.isalpha()
        if i >= window - 1 and digits and letters and math.log2(window) - total / window >= least:
            if spans and spans[-1][1] >= i - window + 1:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i - window + 1, i + 1))
    return spans


def entropy_spans(text: str, raw: bytes) -> list[tuple[int, int]]:
    """Spans in code points. Matches in UTF-8 are moved by the bytes that
    continue a character before them."""
    out, at, shift = [], 0, 0
    plain = len(raw) == len(text)
    for m in RUN.finditer(raw):
        s = m.group().decode()
        if not plain:
            shift += sum((b & 0xC0) == 0x80 for b in raw[at:m.start()]) if m.start() - at < 64 else int(
                np.count_nonzero((np.frombuffer(raw[at:m.start()], "u1") & 0xC0) == 0x80))
            at = m.start()
        if any(p.fullmatch(s) for p in ALLOWED):
            continue
        least = next(e for p, e in CLASSES if p.fullmatch(s))
        out += [(m.start() - shift + a, m.start() - shift + b) for a, b in hot_windows(s, least)]
    return out


def scan(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret, by start and then kind as listed."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    found: list[tuple[int, str, int]] = []
    lowered = text.lower()
    if any(c in lowered for c in CUES):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if has_run(raw, WINDOW):
        found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
        base = list(found)
        found += [(a, "entropy", b) for a, b in entropy_spans(text, raw)
                  if not any(s <= a and b <= e for s, _, e in base)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def written(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def scan_batches(batches):
    for b in batches:
        names = [c for c in b.schema.names if c != "_text"]
        found = [scan(t) for t in b.column("_text").to_pylist()]
        spans = pa.array([[{"kind": k, "start": s, "end": e} for s, k, e in f] for f in found],
                         pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], spans], [*names, "found"])


def find_secrets(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``found``, an array of (kind, start, end), to the columns ``keep`` (default: all but the text).

    Offsets are code points, ends exclusive. Null and empty texts have no
    secrets; very long texts are scanned whole, row by row, without a
    shuffle; repeated rows give repeated results; an empty table gives an
    empty result; a column of ``docs`` named ``found`` is replaced.
    """
    ship(docs.sparkSession)
    names = [c for c in (docs.columns if keep is None else keep) if c not in (text, "_text", "found")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text).cast("string").alias("_text"))
    found = "array<struct<kind:string,start:bigint,end:bigint>>"
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_text").schema)
    return rows.mapInArrow(scan_batches, head + f"found {found}")


def secret_digests(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = find_secrets(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), keep=["doc_id"])

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(col):
        return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("found", lambda x: x["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
                        F.size(F.filter("found", lambda x: x["kind"] == "entropy")).cast("long").alias("n_entropy"))
