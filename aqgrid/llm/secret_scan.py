"""Secret scans: strong patterns alone, weak ones only where the parts of a credential meet within a scope.

A credential has up to three parts: an access identifier, a secret and an endpoint. Strong matches (assignments, access
keys, long hexadecimal strings) are always reported. Weak candidates (user or client identifiers, random-looking
strings, hosts and connection urls) are intervals of code points; an interval join within a scope (``scope`` code points to
either side of a weak candidate, across lines) links them, and a weak candidate is reported only if a complementary
part, strong or weak, lies in its scope. Scopes never leave a document, so each task joins the sorted intervals of one
document at a time and nothing is shuffled.

Nulls: a null text counts as empty and gives no spans; a null id is passed on. Repeated rows each get their row. Extra
columns pass through ``scan_secrets``; if they clash with its own (``spans``), the input's column is dropped. Texts are
read whole; the join is n log n in the candidates of a text. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")

_ASSIGN_HINT = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Weak candidates, one kind for each part.
WEAK_ID = re.compile(r"""(?:client_?id|user_?name|user|login|account|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", re.I | re.A)
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
WEAK_ENDPOINT = re.compile(r"""(?:(?:jdbc:)?[a-z][a-z0-9+]{2,15}://[^\s"'<>]{4,}|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::[0-9]{1,5})?)""", re.I | re.A)
PART = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "id": "id", "endpoint": "endpoint"}
COMPLEMENT = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}

Span = tuple[int, int, str]


def _random_looking(s: str) -> bool:
    """Upper case, lower case and digits mixed, as in generated keys; words and paths are not."""
    return any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s)


def base_spans(text: str) -> list[Span]:
    """Strong spans: leftmost, non-overlapping for each kind, ends exclusive."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _ASSIGN_HINT):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def weak_spans(text: str) -> list[Span]:
    out = [(m.start(), m.end(), "id") for m in WEAK_ID.finditer(text)]
    out += [(m.start(), m.end(), "key") for m in WEAK_KEY.finditer(text) if _random_looking(m[0])]
    return ordered(out + [(m.start(), m.end(), "endpoint") for m in WEAK_ENDPOINT.finditer(text)])


def _maybe_weak(text: str, strong: list[Span]) -> bool:
    """A colon or an equals sign introduces every weak identifier and endpoint; without them only a key is possible,
    whose one complement then is a strong access identifier."""
    return ":" in text or "=" in text or any(s[2] == "access" for s in strong)


def linked(strong: list[Span], weak: list[Span], scope: int) -> list[Span]:
    """Weak spans of which a complementary part lies at most ``scope`` code points away: a sorted interval join."""
    by_part: dict[str, list[Span]] = {"id": [], "secret": [], "endpoint": []}
    for s in ordered(strong + weak):
        by_part[PART[s[2]]].append(s)
    # starts are sorted; ends are not, so the largest end so far bounds the search to the left
    starts = {p: [s[0] for s in v] for p, v in by_part.items()}
    ends = {p: _running_max([s[1] for s in v]) for p, v in by_part.items()}
    covered = _Cover(strong)
    out = []
    for s in weak:
        if covered.overlaps(s):
            continue  # a strong span says it already
        for p in COMPLEMENT[PART[s[2]]]:
            hi = bisect.bisect_right(starts[p], s[1] + scope)
            lo = bisect.bisect_left(ends[p], s[0] - scope)
            if any(by_part[p][k][1] >= s[0] - scope and not _overlap(by_part[p][k], s) for k in range(lo, hi)):
                out.append(s)
                break
    return out


def _running_max(v: list[int]) -> list[int]:
    out, top = [], -1
    for x in v:
        top = max(top, x)
        out.append(top)
    return out


def _overlap(a: Span, b: Span) -> bool:
    return a[0] < b[1] and b[0] < a[1]


class _Cover:
    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s[0] for s in self.spans]
        self.ends = _running_max([s[1] for s in self.spans])

    def overlaps(self, s: Span) -> bool:
        k = bisect.bisect_left(self.starts, s[1])
        return bool(k) and self.ends[k - 1] > s[0]


def scan(text: str | None, scope: int = 200) -> tuple[list[Span], list[Span]]:
    """Base spans and linked weak spans of one text."""
    if not text:
        return [], []
    strong = base_spans(text)
    # a weak part needs a complement; without any sign of one there is nothing to join
    weak = weak_spans(text) if _maybe_weak(text, strong) else []
    return strong, linked(strong, weak, scope) if weak else []


def show(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_secrets(docs: DataFrame, *, text_col: str = "text", scope: int = 200) -> DataFrame:
    """All columns of ``docs`` and ``spans`` array<struct<kind, start, end, weak>>, sorted by start then kind."""
    kind = "array<struct<kind:string,start:int,end:int,weak:boolean>>"

    @F.pandas_udf(kind)
    def found(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            strong, weak = scan(t, scope)
            both = [(*s, False) for s in strong] + [(*s, True) for s in weak]
            both.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            out.append([{"kind": k, "start": a, "end": b, "weak": w} for a, b, k, w in both])
        return pd.Series(out)

    return docs.withColumn("spans", found(F.col(text_col)))


def redact(docs: DataFrame, *, text_col: str = "text", scope: int = 200, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mask``; overlapping spans are masked as one."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([_masked(t, scope, mask) for t in texts], dtype=object)

    return docs.withColumn(text_col, masked(F.col(text_col)))


def _masked(text: str | None, scope: int, mask: str) -> str | None:
    if not text:
        return text
    strong, weak = scan(text, scope)
    if not strong and not weak:
        return text
    out, at = [], 0
    for a, b in _merged(strong + weak):
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def _merged(spans: list[Span]) -> Iterator[tuple[int, int]]:
    a = b = None
    for s in sorted(spans):
        if b is not None and s[0] < b:
            b = max(b, s[1])
        else:
            if b is not None:
                yield a, b
            a, b = s[0], s[1]
    if b is not None:
        yield a, b


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """The digest that the query returns, from the spans of ``scan_secrets``."""
    s = scan_secrets(docs.select(id_col, text_col), text_col=text_col, scope=scope)
    joined = lambda a: F.concat_ws(",", F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("spans", lambda x: ~x["weak"])
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return s.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def base_sha256(text: str | None) -> str:
    """The digest of one text's base spans; for tests."""
    return hashlib.sha256(show(base_spans(text or "")).encode()).hexdigest()
