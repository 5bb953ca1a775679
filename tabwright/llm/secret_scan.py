"""Secret scan: keys by their form, and unknown ones by the entropy of sliding windows.

Three forms are looked for as they are: assignments to names such as password, access key
ids, and long hexadecimal numbers. Besides, every run of characters that keys are written
in is a candidate string. For each character class (hexadecimal digits, letters and digits
with the signs of base 64) a window slides over the stretches of the candidate that lie in
the class; its Shannon entropy is kept by counts that change by one character in and one
out. Windows at or above the limit of the class join to spans of kind ``entropy``. A limit
lies below what random characters of the class reach in such a window and above what words
do. What an allow-list knows is no secret: it suppresses candidates as a whole (UUIDs,
paths and addresses, placeholders), runs behind the name of a checksum, and windows of
letters alone or of characters in their natural order. It never suppresses the three
forms. A document is judged by itself: nothing is shuffled, and a text is one row's own
string however long.

Defined cases: NULL and empty texts have no spans; spans are in code points, the end
exclusive, ordered by start, then by kind in the order of ``KINDS``; spans of different
kinds may overlap; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The forms and their least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: Runs of 16 hexadecimal digits; the same matches as the form with its length, sooner found.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")


class CharacterClass(NamedTuple):
    name: str
    pattern: str
    window: int
    limit: float


#: A window of random characters has 3.6 bits (hexadecimal) and 4.5 (base 64) on average
#: and falls below the limit once in some thousand windows; words stay under 3.9.
CLASSES = (
    CharacterClass("hex", "[0-9A-Fa-f]", 32, 3.1),
    CharacterClass("base64", "[A-Za-z0-9+/_-]", 28, 4.1),
)
#: Shortest window of any class; shorter candidates hold none.
_CANDIDATE = "[A-Za-z0-9+/=_.:%-]{{{least},}}"

#: Allow-list, whole candidates.
ALLOWED_CANDIDATES = (
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUID
    r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//.*",  # address
    r"(?:[A-Za-z0-9_.-]*/){3,}[A-Za-z0-9_.-]*",  # path
    r"(?:[A-Za-z0-9-]+\.){2,}[A-Za-z]{2,10}",  # host name
    r"(?i:.*(?:example|placeholder|changeme|dummy|sample|redacted).*)",
)
#: Allow-list, what stands right before a stretch of one class.
ALLOWED_BEFORE = r"(?i:sha-?(?:1|224|256|384|512)|md5|checksum|digest|etag|integrity|commit|base64,)[\"' ]?[-:= ]?[\"' ]?"
#: Allow-list, windows: strings that only count up or down, such as alphabets.
_ORDERED_SHARE = 0.5


class _Scanner:
    """Forms, classes and allow-list, compiled once for each task."""

    def __init__(self, classes: tuple[CharacterClass, ...], allowed: tuple[str, ...], before: str):
        least = min(c.window for c in classes)
        self.candidate = re.compile(_CANDIDATE.format(least=least))
        self.classes = [(re.compile(f"{c.pattern}{{{c.window},}}"), c.window, c.limit, [0.0, *(n * log2(n) for n in range(1, c.window + 1))]) for c in classes]
        self.allowed = re.compile("|".join(f"(?:{a})" for a in allowed)) if allowed else None
        self.before = re.compile(f"(?:{before})\\Z") if before else None

    def forms(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, kind, end) of the three forms."""
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGNED:
                yield m.start(), 0, m.end()
        if "AKIA" in text:
            for m in _ACCESS.finditer(text):
                if m.end() - m.start() >= LEAST_ACCESS:
                    yield m.start(), 1, m.end()
        for m in _LONG_HEX.finditer(text):
            yield m.start(), 2, m.end()

    def entropy(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, kind, end) of joined windows of high entropy."""
        for m in self.candidate.finditer(text):
            start, word = m.start(), m[0]
            if self.allowed and self.allowed.fullmatch(word):
                continue
            spans: list[tuple[int, int]] = []
            for stretch, window, limit, sums in self.classes:
                for s in stretch.finditer(word):
                    first = start + s.start()
                    if not (self.before and self.before.search(text[max(0, first - 24) : first])):
                        spans += [(first + a, first + b) for a, b in dense_windows(s[0], window, limit, sums)]
            spans.sort()
            joined: list[list[int]] = []
            for a, b in spans:
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            for a, b in joined:
                yield a, 3, b

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        return sorted([*self.forms(text), *self.entropy(text)]) if text else []


def dense_windows(text: str, window: int, limit: float, sums: list[float] | None = None) -> list[tuple[int, int]]:
    """Joined windows of ``window`` characters with an entropy of at least ``limit`` bits.

    The entropy is log2(window) - sum(c * log2(c)) / window over the counts c in the window;
    the sum changes by two counts from one window to the next. Windows of letters alone
    and windows mostly in counting order do not count.
    """
    sums = sums or [0.0, *(n * log2(n) for n in range(1, window + 1))]
    # sum(c * log2(c)) may be this high; the small share makes up for rounding.
    most = window * (log2(window) - limit) + 1e-9
    counts: dict[str, int] = {}
    total, digits, ordered, found = 0.0, 0, 0, []
    for i, c in enumerate(text):
        if i >= window:
            old = text[i - window]
            n = counts[old]
            counts[old] = n - 1
            total += sums[n - 1] - sums[n]
            digits -= old.isdigit()
            ordered -= abs(ord(text[i - window + 1]) - ord(old)) == 1
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += sums[n + 1] - sums[n]
        digits += c.isdigit()
        ordered += i > 0 and abs(ord(c) - ord(text[i - 1])) == 1
        if i >= window - 1 and total <= most and digits and ordered <= _ORDERED_SHARE * window:
            a, b = i - window + 1, i + 1
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
    return found


def _scan(batches: Iterator[pa.RecordBatch], scanner: tuple) -> Iterator[pa.RecordBatch]:
    scan = _Scanner(*scanner).scan
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.string())]))
    for batch in batches:
        texts, found = batch.column(batch.num_columns - 1), []
        for i in range(batch.num_rows):  # one text at a time: some are very long
            text = texts[i].as_py()
            found.append([{"kind": KINDS[k], "start": a, "end": b, "secret": text[a:b]} for a, k, b in scan(text)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], [*batch.schema.names[:-1], "found"])


def scan_secrets(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED_CANDIDATES, before: str = ALLOWED_BEFORE,
) -> DataFrame:
    """The columns ``keep`` and ``found``: kind, start, end and text of every span, in order."""
    kept = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep)
    return docs.select(*keep, text).mapInArrow(
        partial(_scan, scanner=(classes, allowed, before)),
        f"{kept}, found array<struct<kind:string,start:bigint,end:bigint,secret:string>>",
    )


def spelled(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    mine = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of each form, a digest of their spans, and all spans, per document."""
    found = F.col("found")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return scan_secrets(docs).select(
        "doc_id", *counts, F.sha2(spelled(found, KINDS[:3]), 256).alias("base_sha256"), spelled(found).alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "*") -> DataFrame:
    """``docs`` with every character of a found span replaced by ``mark``; NULL texts stay."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scanner(CLASSES, ALLOWED_CANDIDATES, ALLOWED_BEFORE).scan
        for batch in batches:
            at, out = batch.schema.get_field_index("text"), []
            for i in range(batch.num_rows):
                text = batch.column(at)[i].as_py()
                parts, done = [], 0
                for a, _, b in scan(text):
                    if b > done:
                        a = max(a, done)
                        parts += [text[done:a], mark * (b - a)]
                        done = b
                out.append(text if text is None else "".join([*parts, text[done:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)
