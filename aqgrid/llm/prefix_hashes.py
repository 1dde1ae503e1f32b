"""Document fingerprints from prefix polynomial hashes.

The code points of a text are the coefficients of a polynomial, taken modulo 2**31 - 1 at two points. An array of its prefixes
answers the hash of any span by one subtraction and one multiplication, hence whether two spans are equal, and by binary
search how far two texts go on alike. The fingerprint of a text is its length, the hash of the whole, and the smallest ``KEEP``
of the mixed hashes of its windows of ``WINDOW`` code points; from two fingerprints follows the likeness of their texts, the
share of windows that they have in common (Dice), exact below ``KEEP`` windows and estimated above. Long texts are taken in
blocks, so that the arrays stay bounded.

``neighbours`` compares each document with a text made of it and of the next document, in descending order of the ids. It deals
the rows by ranges of the ids, a task streams its range in order, and only the row before each range travels twice. Rows that
share an id are ordered by their texts.

Nulls: a null text is empty; rows without an id come last in the descending order. Equal texts have equal fingerprints and a
likeness of 1, an empty text has none with any other. Repeated rows each get their row. Extra columns are dropped, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aqgrid.llm.common import mix
from aqgrid.operators import order

P = (1 << 31) - 1
POINTS = (1_220_703_125, 762_939_453)
#: Code points of a window, and windows that a fingerprint keeps.
WINDOW, KEEP = 24, 64
#: Code points whose prefixes are held at once.
BLOCK = 1 << 18


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo P for x below 2**62."""
    x = (x & np.uint64(P)) + (x >> np.uint64(31))
    x = (x & np.uint64(P)) + (x >> np.uint64(31))
    return np.where(x == np.uint64(P), np.uint64(0), x)


class _Powers:
    """Powers of a point and of its inverse, as far as they have been asked for."""

    def __init__(self, point: int):
        self.up = self.down = np.ones(1, np.uint64)
        self.point, self.inverse = point, pow(point, P - 2, P)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate((self.up, _mod(self.up * np.uint64(pow(self.point, size, P)))))
            self.down = np.concatenate((self.down, _mod(self.down * np.uint64(pow(self.inverse, size, P)))))
        return self.up[:n], self.down[:n]


_POWERS = tuple(_Powers(p) for p in POINTS)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class PrefixHashes:
    """Hashes of the prefixes of one block of text."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        c = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for powers in _POWERS:
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_mod(c * powers.to(self.n)[0]), out=s[1:])
            self.sums.append(_mod(s))

    def span(self, at: int, n: int) -> tuple[int, int]:
        """The hash of n code points from ``at`` on, the same wherever they stand."""
        return tuple(int(s[at + n]) - int(s[at]) if not at else (int(s[at + n]) - int(s[at])) * pow(w.inverse, at, P) % P for s, w in zip(self.sums, _POWERS, strict=True))

    def windows(self, w: int) -> np.ndarray:
        """The hashes of all spans of w code points, both points in one number."""
        if self.n < w:
            return np.zeros(0, np.uint64)
        out = []
        for s, powers in zip(self.sums, _POWERS, strict=True):
            d = s[w:] + np.uint64(P) - s[:-w]
            out.append(_mod(_mod(d) * powers.to(self.n)[1][: self.n - w + 1]))
        return out[0] << np.uint64(31) | out[1]


def spans_equal(a: str, i: int, b: str, j: int, n: int) -> bool:
    """Whether n code points of a from i on equal those of b from j on; spans that run over an end are unequal."""
    if min(i, j, n) < 0 or i + n > len(a) or j + n > len(b):
        return False
    for at in range(0, n, BLOCK):
        m = min(BLOCK, n - at)
        x, y = PrefixHashes(code_points(a[i + at : i + at + m])), PrefixHashes(code_points(b[j + at : j + at + m]))
        if x.span(0, m) != y.span(0, m):
            return False
    return True


def extension(a: str, i: int, b: str, j: int) -> int:
    """The longest common extension: how many code points of a from i on and of b from j on are the same."""
    total = 0
    while True:
        x, y = PrefixHashes(code_points(a[i + total : i + total + BLOCK])), PrefixHashes(code_points(b[j + total : j + total + BLOCK]))
        low, high = 0, min(x.n, y.n)
        if high and x.span(0, high) == y.span(0, high):
            low = high
        while low < high:  # the spans up to low are equal, those over high aren't
            middle = (low + high + 1) // 2
            if x.span(0, middle) == y.span(0, middle):
                low = middle
            else:
                high = middle - 1
        total += low
        if low < BLOCK:
            return total


class Fingerprint(NamedTuple):
    """Length, whole hash, and the smallest mixed hashes of the windows, ascending."""

    n: int
    whole: tuple[int, int]
    least: tuple[int, ...]

    def __str__(self) -> str:
        return f"{self.n:x}-{self.whole[0]:08x}{self.whole[1]:08x}-" + "".join(f"{x:08x}" for x in self.least)

    @classmethod
    def parse(cls, shown: str) -> Fingerprint:
        n, whole, least = shown.split("-")
        return cls(int(n, 16), (int(whole[:8], 16), int(whole[8:], 16)), tuple(int(least[i : i + 8], 16) for i in range(0, len(least), 8)))


def _smallest(x: np.ndarray) -> np.ndarray:
    """The KEEP smallest distinct values."""
    if len(x) > 8 * KEEP:
        few = np.unique(np.partition(x, 4 * KEEP)[: 4 * KEEP])
        if len(few) >= KEEP:
            return few[:KEEP]
    return np.unique(x)[:KEEP]


def fingerprint(text: str) -> Fingerprint:
    """A text shorter than a window has one window, itself."""
    n, whole, least = len(text), [0, 0], np.zeros(0, np.uint64)
    for at in range(0, n, BLOCK):  # blocks overlap by what a window needs
        part = PrefixHashes(code_points(text[at : at + BLOCK + WINDOW - 1]))
        sums = part.span(0, min(BLOCK, n - at))
        whole = [(h + s * pow(p, at, P)) % P for h, s, p in zip(whole, sums, POINTS, strict=True)]
        hashes = part.windows(WINDOW) if n >= WINDOW else np.array([sums[0] << 31 | sums[1]], np.uint64)
        least = _smallest(np.concatenate((least, _smallest(mix(hashes) >> np.uint64(32)))))
    return Fingerprint(n, (whole[0] % P, whole[1] % P), tuple(least.tolist()))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """The share of windows in common, 2 |A and B| / (|A| + |B|), from the smallest of their union."""
    if a == b:
        return 1.0
    x, y = set(a.least), set(b.least)
    if not x or not y:
        return 0.0
    union = sorted(x | y)
    if len(x) == KEEP or len(y) == KEEP:  # beyond the smallest KEEP of the union one of them may lack values
        union = union[:KEEP]
    share = sum(v in x and v in y for v in union) / len(union)
    return 2 * share / (1 + share)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars and fingerprint of every text; no row is moved."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.n for f in found], pa.int64()), pa.array([str(f) for f in found], pa.string())], names=[id_col, "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_chars long, fingerprint string")


def extensions(pairs: DataFrame, left: str, at: str, right: str, to: str, *, name: str = "extension") -> DataFrame:
    """The pairs with the longest common extension of two texts from two places on; null if a text or a place is null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            four = zip(*(batch.column(c).to_pylist() for c in (left, at, right, to)), strict=True)
            found = [None if None in x else extension(x[0], max(0, x[1]), x[2], max(0, x[3])) for x in four]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, name])

    pairs = pairs.drop(name) if name not in (left, at, right, to) else pairs
    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField(name, LongType())]))


NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_prefix long"


def neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Each document against its edited text, whose last third is the beginning of the next document, and against the next one.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and kept_prefix: how many code
    points the document and its edited text begin with alike.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    ends = order.bounds(rows, "doc_id", ranges)
    n = max(1, len(ends))
    rows = rows.withColumn("part", order.range_of(F.col("doc_id"), ends).cast("int"))
    # in ascending order the next document is the row before; the last row of each range also goes to the range after it
    last = rows.where(F.col("doc_id").isin(ends)) if ends else rows
    last = last.groupBy("part").agg(F.max(F.struct("doc_id", "text")).alias("r"))
    last = last.select("r.doc_id", "r.text", F.pmod(F.col("part") + 1, F.lit(n)).cast("int").alias("part"), F.lit(True).alias("ahead"))
    dealt = rows.withColumn("ahead", F.lit(False)).unionByName(last).repartitionById(n, "part")
    dealt = dealt.sortWithinPartitions("part", F.desc("ahead"), F.asc_nulls_first("doc_id"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: str = ""
        known: Fingerprint | None = None
        for batch in batches:
            out: list[tuple] = []
            for doc, text, ahead in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = known if known is not None and text == before else fingerprint(text)
                if not ahead:
                    cut = len(text) // 3
                    edited = text[: len(text) - cut] + before[:cut]
                    other = mine if edited == text else fingerprint(edited)
                    sha = hashlib.sha256(edited.encode()).hexdigest()
                    out.append((doc, len(text), sha, str(mine), str(other), likeness(mine, other), likeness(mine, known), extension(text, 0, edited, 0)))
                before, known = text, mine
            if out:
                columns = zip(*out, strict=True)
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in NEIGHBOURS.split(", ")])

    return dealt.select("doc_id", "text", "ahead").mapInArrow(run, NEIGHBOURS)
