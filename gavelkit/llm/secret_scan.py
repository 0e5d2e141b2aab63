"""Secret scans: fixed patterns, and entropy in a sliding window over candidate strings."""

from __future__ import annotations

import re
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import arrow_rows, new_name

# The base kinds, in order, with their patterns and least lengths.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Strings that may hide a secret: long runs of key characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Character classes: name, pattern of a string of the class, bits a character that a window must reach.
#: Left out: lower-case letters with digits, upper-case letters with digits, letters alone; hex in a longer run is in the mixed class.
CLASSES = (
    ("entropy_hex", re.compile(r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f-]+"), 3.0),
    ("entropy_mixed", re.compile(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+"), 3.9),
)
#: What looks random and is none: ids with dashes, paths of words, and plain examples.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"(?:/?[a-z]+)+/?",
    r"(?i:.*example.*)",
)
WINDOW = 20
_KIND = pa.struct([("kind", pa.list_(pa.string())), ("start", pa.list_(pa.int64())), ("end", pa.list_(pa.int64()))])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of what the fixed patterns find; leftmost, without overlap in a kind."""
    out = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]


def hot_windows(run: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of ``run`` covered by windows whose Shannon entropy reaches ``bits``.

    Moving the window by one character changes two counts, so the sum of c*log2(c) is corrected, not made anew.
    """
    term = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, most, found = 0.0, log2(window) - bits, []
    for k, c in enumerate(run):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        if k >= window:
            n = counts[gone := run[k - window]]
            total += term[n - 1] - term[n]
            counts[gone] = n - 1
        if k >= window - 1 and total / window <= most + 1e-9:
            if found and found[-1][1] >= k - window + 1:
                found[-1] = (found[-1][0], k + 1)
            else:
                found.append((k - window + 1, k + 1))
    return found


def scanner(allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW):
    """The function for one text: all spans, by start, then kind in the order of KINDS."""
    permit = [re.compile(p) for p in allowed]
    rank = {k: n for n, k in enumerate(KINDS)}

    def scan(text: str | None) -> list[tuple[int, int, str]]:
        if not text:
            return []
        out = base_spans(text)
        for m in CANDIDATE.finditer(text):
            run = m.group()
            if any(p.fullmatch(run) for p in permit):
                continue
            for kind, shape, bits in CLASSES:
                if shape.fullmatch(run):
                    out += [(m.start() + a, m.start() + b, kind) for a, b in hot_windows(run, bits, window)]
                    break
        return sorted(out, key=lambda x: (x[0], rank[x[2]]))

    return scan


def secret_spans(text: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Struct of three equally long arrays: kind, start, end (code points, end exclusive).

    Null and empty texts have empty arrays. The allow-list suppresses entropy spans only; what a base pattern finds stays.
    Keys of lower-case letters and digits, of upper-case letters and digits, or of letters alone have no entropy spans.
    Long texts are scanned whole; equal texts give equal spans.
    """

    def make():
        scan = scanner(allowed)

        def one(text: str | None) -> tuple[list, list, list]:
            spans = scan(text)
            return [x[2] for x in spans], [x[0] for x in spans], [x[1] for x in spans]

        return one

    return arrow_rows(make, "kind array<string>, start array<bigint>, end array<bigint>", _KIND)(text)


def with_spans(df: DataFrame, text: str = "text", out: str = "secrets", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``df`` with a struct column ``out`` of the spans; every row stays."""
    return df.withColumn(out, secret_spans(F.col(text), allowed))


def blanked(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """``text`` with each stretch that spans cover replaced by ``mark``."""
    out, at, end = [], 0, -1
    for a, b in sorted(spans):
        if a > end:
            out += [text[at:a], mark]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``df`` with secrets in ``text`` replaced by a mark; every row and column stays, null stays null."""

    def make():
        scan = scanner(allowed)

        def one(value: str | None) -> tuple[str | None]:
            spans = scan(value)
            return (blanked(value, [x[:2] for x in spans]) if spans else value,)

        return one

    name = new_name(df, "gk_redacted")
    hidden = arrow_rows(make, "text string", pa.struct([("text", pa.string())]))(F.col(text))
    return df.withColumn(name, hidden).withColumn(text, F.col(name)["text"]).drop(name)
