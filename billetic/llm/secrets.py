"""Secret scans: fixed patterns, and sliding-window entropy per character class.

Patterns (leftmost, non-overlapping per kind; too short matches are dropped
after they have taken their place): ``assign`` (a password-like name, a
separator and a value of 6 or more characters; the span is the whole match),
``access`` (AKIA keys of 20 or more), ``hex`` (runs of 24 or more).

Entropy adds spans. A candidate is a maximal run of a class's alphabet, at
least as long as the class's window. A window slides over it by one
character; counts of the character that leaves and the one that enters are
updated, and with them the sum of c log2 c, so each step is constant work.
Windows with at least the class's bits per character, and the mix of letters
and digits it asks for, are joined to spans. Keys of lower case and digits, of
upper case and digits and of mixed letters alone have classes of their own,
for the wide class asks for all three. A span is dropped if it lies in
one of the patterns' spans, or if an allow-list pattern covers it (UUIDs,
digests named as such, addresses, alphabets in order, EXAMPLE keys).

Offsets are code points, ends exclusive. Defined cases: null and empty texts
have no spans; a text of any length is scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# The patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")      # the runs of 24 and more of [0-9a-f]+
NAMES = ("password", "passwd", "secret", "token", "api")
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """A class of characters: runs of ``alphabet``, windows of ``window``
    with at least ``bits`` per character that hold each of ``needs``."""

    name: str
    alphabet: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()
    run: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "run", re.compile(
            f"(?<![{self.alphabet}])[{self.alphabet}]{{{self.window},}}"))


CLASSES = (
    CharClass("entropy_hex", "0-9A-Fa-f", 20, 2.9, ("0-9", "A-Fa-f")),
    CharClass("entropy_base64", "A-Za-z0-9+/=_-", 24, 3.9, ("0-9", "A-Z", "a-z")),
    # bits: a random key of 24, 32 and 40 characters has a window in 99.0, 100 and 100 of 100 (3000 keys each),
    # 98.6, 99.6 and 100 (base32), 96.0, 99.6 and 99.9; long CamelCase words can reach the last.
    CharClass("entropy_lower", "0-9a-z", 24, 3.6, ("0-9", "a-z")),
    CharClass("entropy_upper", "0-9A-Z", 24, 3.5, ("0-9", "A-Z")),
    CharClass("entropy_letters", "A-Za-z", 24, 3.9, ("A-Z", "a-z")),
)
ALLOW = (
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(?i:sha(?:1|256|384|512)|md5)[-:= ]+[0-9A-Za-z+/=]+",
    r"https?://(?![^\s/?#]*@)[^\s?#]+",     # scheme, host and path: keys in user-info, query or fragment are found
    r"data:[a-z]+/[\w.+-]+;base64,[A-Za-z0-9+/=]+",
    r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]*EXAMPLE[0-9A-Za-z+/_=-]*",     # tried once a run
    r"(?i:0123456789abcdef|abcdefghijklmnopqrstuvwxyz)[0-9A-Za-z+/_=-]*",
)


def hot_windows(s: str, window: int, bits: float, needs: Sequence[str] = ()) -> Iterator[tuple[int, int]]:
    """Spans of ``s`` covered by windows of at least ``bits`` per character
    that hold a character of each class in ``needs``."""
    groups = [re.compile(f"[{n}]") for n in needs]
    member = {c: [bool(g.match(c)) for g in groups] for c in set(s)}
    log = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts, have, total = dict.fromkeys(member, 0), [0] * len(groups), 0.0
    limit = (math.log2(window) - bits) * window + 1e-9     # H = log2 w - (sum c log2 c) / w
    begin = end = -1
    for i, c in enumerate(s):
        total += log[counts[c] + 1] - log[counts[c]]
        counts[c] += 1
        for k, inside in enumerate(member[c]):
            have[k] += inside
        if i >= window:
            gone = s[i - window]
            total += log[counts[gone] - 1] - log[counts[gone]]
            counts[gone] -= 1
            for k, inside in enumerate(member[gone]):
                have[k] -= inside
        if i >= window - 1 and total <= limit and all(have):
            if begin < 0:
                begin = i - window + 1
            elif i - window + 1 > end:
                yield begin, end
                begin = i - window + 1
            end = i + 1
    if begin >= 0:
        yield begin, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end)."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def entropy_spans(text: str, base: list[tuple[int, int, int]], classes: Sequence[CharClass] = CLASSES,
                  allow: Sequence[str] = ALLOW) -> list[tuple[int, int, int]]:
    out = []
    for k, cls in enumerate(classes):
        for m in cls.run.finditer(text):
            for a, b in hot_windows(m[0], cls.window, cls.bits, cls.needs):
                out.append((m.start() + a, len(BASE_KINDS) + k, m.start() + b))
    if not out:
        return out
    known = [(a, b) for a, _, b in base]
    for pattern in allow:
        known += [m.span() for m in re.finditer(pattern, text)]
    known.sort()
    starts, reach, upto = [], [], -1
    for a, b in known:
        upto = max(upto, b)
        starts.append(a)
        reach.append(upto)
    from bisect import bisect_right

    return sorted(s for s in out if not (i := bisect_right(starts, s[0])) or reach[i - 1] < s[2])


def scan(text: str | None, classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW
         ) -> tuple[int, int, int, str, str]:
    """Counts of the three patterns, SHA-256 of their spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    names = (*BASE_KINDS, *(c.name for c in classes))

    def listed(spans):
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)

    n = [sum(1 for _, k, _ in base if k == i) for i in range(3)]
    digest = hashlib.sha256(listed(base).encode()).hexdigest()
    return (*n, digest, listed(sorted(base + entropy_spans(text, base, classes, allow))))


def secrets(text: Column | str, classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW) -> Column:
    """Struct (n_assign, n_access, n_hex, base_sha256, spans) of a text column."""

    @pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([scan(t, classes, allow) for t in texts],
                               columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return of(text)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` per row."""
    return docs.select(F.col(id_col).alias("doc_id"), secrets(text_col, **options).alias("found")).select(
        "doc_id", "found.*")
