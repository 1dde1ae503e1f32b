"""Benchmark decontamination by the q-gram lemma.

A text within k edits of an item of m characters shares at least T = m + 1 - q (k + 1) of the item's q-grams with it, on
diagonals at most k apart. Hits (document place, item place) are counted in overlapping bands of 2 (k + 1) diagonals,
every k + 1 diagonals a new one, so that some band holds all of an occurrence's hits. Bands with T hits or more are
verified by banded alignment of the whole item against the region.

Before hits are expanded, places of a document count only near a run of hits: k edits leave at least one of k + 1 parts
of the item intact, hence a run of floor(m / (k + 1)) - q + 1 consecutive hits (at least; bands are looked at around every
such run only). Nothing is lost by it.

Items are the small side: they travel with the task, in parts of about ``PART_CHARS`` characters dealt by the hash of the item,
one part after the other, so that a benchmark of any size is searched for whole while a task holds one part. Documents are
scanned once for each part (one, for most benchmarks), in chunks, whole, without a shuffle; a run of equal neighbours or a
popular passage makes work only in proportion to the text that holds it. q-grams are hashed and hits expanded in steps that overlap
by all that one occurrence can span, so that a very long text needs little more memory than the text itself.

Texts are compared lower-cased with white space as single spaces; start and end are places in that form. The edit budget is
``rate`` of an item's length, less where T would fall under 1; an item shorter than q is searched for as it stands. Empty
and null items match nothing, null documents are empty, null ids are passed on. Repeated items or documents each give
their rows; of overlapping occurrences of one item in a document the best (fewest edits, then first) is kept. Extra
columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from aqgrid.llm.common import STEP, chunks, mix

#: Characters of the items that are searched for at once, about.
PART_CHARS = 16 << 20
_SLOT_BITS = 22
#: Bytes of text in a chunk, and characters of a text that are normalised, hashed or looked at for bands in one step.
CHUNK, STEP_CHARS = 1 << 20, 1 << 17
_WHITE = re.compile(r"\s")


def normal(text: str | None) -> str:
    """The text lower-cased, with white space as single spaces; a long one in pieces that end at white space."""
    if not text:
        return ""
    parts, at = [], 0
    while len(text) - at > CHUNK and (m := _WHITE.search(text, at + CHUNK)):
        parts.append(" ".join(text[at : m.start()].lower().split()))
        at = m.start()
    parts.append(" ".join((text[at:] if at else text).lower().split()))
    return " ".join(filter(None, parts))


def budget(m: int, q: int, rate: float) -> int:
    """Edits allowed for an item of m characters: the rate, as long as the lemma asks for one shared q-gram."""
    return max(0, min(int(m * rate), (m + 1) // q - 1))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, built by doubling."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = (codes + np.uint64(1)) * STEP[0]
    have, width, out = 0, 1, None
    while True:
        if q & width:  # append this block to what there is
            out = power[:n].copy() if out is None else out[:n] * STEP[8 + width.bit_length()] + power[have : have + n]
            have += width
        if have == q:
            return mix(out)
        power = power[: len(power) - width] * STEP[16 + width.bit_length()] + power[width:]
        width *= 2


class Index:
    """q-grams of all items, sorted, with a bitmap in front."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        self.q, self.ids, self.texts = q, [], []
        for i, t in items:
            t = normal(t)
            if t:
                self.ids.append(i)
                self.texts.append(t)
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.array([budget(m, q, rate) for m in self.m], np.int64)
        self.need = self.m + 1 - q * (self.k + 1)
        self.short = [j for j, m in enumerate(self.m) if m < q]
        grams = [gram_hashes(_codes(t), q) for t in self.texts]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order].astype(np.int64), place[order].astype(np.int64)
        self.unique, self.begin = np.unique(self.hashes, return_index=True)
        self.until = np.append(self.begin[1:], len(self.hashes))
        self.bitmap = np.zeros(1 << _SLOT_BITS, bool)
        self.bitmap[(self.hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)] = True
        long = self.m >= q
        self.run = int((self.m[long] // (self.k[long] + 1) - q + 1).min()) if long.any() else 0
        self.reach = int((self.m + self.k).max()) if len(self.m) else 0


def align(item: str, region: str, k: int) -> tuple[int, int, int] | None:
    """Fewest edits of the whole item against any part of the region, if at most k: (edits, start, end).

    Only cells with at most k edits are kept, by column; a cell carries where its match began.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if k == 0:
        return None
    m, best = len(item), (len(item), 0, 0) if len(item) <= k else None
    col = {i: (i, 0) for i in range(k + 1)}  # item prefix length -> (edits, start)
    for j, c in enumerate(region, 1):
        new = {0: (0, j)}
        todo, at, i = sorted({x for p in col for x in (p, p + 1) if 1 <= x <= m} | {1}), 0, m + 1
        while at < len(todo) or i <= m:
            if at < len(todo) and todo[at] <= i:
                i, at = todo[at], at + 1
            options = []
            if i - 1 in col:
                options.append((col[i - 1][0] + (item[i - 1] != c), col[i - 1][1]))
            if i in col:
                options.append((col[i][0] + 1, col[i][1]))
            if i - 1 in new:
                options.append((new[i - 1][0] + 1, new[i - 1][1]))
            least = min(options, key=lambda x: (x[0], -x[1]), default=(k + 1, 0))
            if least[0] <= k:
                new[i] = least
            i = i + 1 if i in new else m + 1
        if m in new and (best is None or new[m][0] < best[0]):
            best = (new[m][0], new[m][1], j)
        col = new
    return best


class Scanner:
    def __init__(self, index: Index):
        self.x = index

    def scan(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(document number, item number, start, end, edits) of the occurrences in normalised texts."""
        x, out = self.x, []
        for j in x.short:
            for d, t in enumerate(texts):
                at = t.find(x.texts[j])
                while at >= 0:
                    out.append((d, j, at, at + int(x.m[j]), 0))
                    at = t.find(x.texts[j], at + int(x.m[j]))
        if not len(x.hashes):
            return out
        joined = "\n".join(texts)  # a newline is in no item: white space became spaces
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        found: dict[tuple[int, int], set[tuple[int, int, int]]] = defaultdict(set)
        overlap = x.reach + 2 * (int(x.k.max()) + 1)  # what the hits of a band, and the run among them, can span
        step = max(STEP_CHARS, 4 * overlap)
        for a in range(0, len(joined) - x.q + 1, step):
            at, slot = self._hits(joined, a, a + step + overlap)
            near = self._near_runs(at)
            at, slot = at[near], slot[near]
            doc = np.searchsorted(first, at, side="right") - 1
            cuts = np.flatnonzero(np.diff(doc)) + 1
            for y, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                if y < z:
                    d = int(doc[y])
                    for j, span in self._bands(texts[d], at[y:z] - first[d], slot[y:z]):
                        found[d, j].add(span)
        for (d, j), spans in found.items():
            taken: list[tuple[int, int]] = []  # apart from each other and sorted, so that the neighbours decide
            for e, s, t in sorted(spans):
                k = bisect.bisect_left(taken, (s, t))
                if (k == 0 or taken[k - 1][1] <= s) and (k == len(taken) or t <= taken[k][0]):
                    taken.insert(k, (s, t))
                    out.append((d, j, s, t, e))
        return out

    def _hits(self, joined: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from a to b whose q-gram an item has, and which one."""
        x = self.x
        h = gram_hashes(_codes(joined[a : b + x.q - 1]), x.q)
        at = np.flatnonzero(x.bitmap[(h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(x.unique, h[at]), len(x.unique) - 1)
        true = x.unique[slot] == h[at]
        return at[true] + a, slot[true]

    def _near_runs(self, at: np.ndarray) -> np.ndarray:
        """Hits within reach of a run of hits at consecutive places."""
        run, reach = max(1, self.x.run), self.x.reach
        if not len(at):
            return np.zeros(0, bool)
        last = len(at) - run
        if last < 0:
            return np.zeros(len(at), bool)
        starts = at[: last + 1][at[run - 1 :] - at[: last + 1] == run - 1] if run > 1 else at
        if not len(starts):
            return np.zeros(len(at), bool)
        right = np.searchsorted(starts, at - reach, side="left")
        return (right < len(starts)) & (starts[np.minimum(right, len(starts) - 1)] <= at + reach)

    def _bands(self, text: str, at: np.ndarray, slot: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int]]]:
        """(item number, (edits, start, end)) of the bands with enough hits."""
        x = self.x
        n = x.until[slot] - x.begin[slot]
        which = np.repeat(x.begin[slot] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        item, diagonal = x.item[which], np.repeat(at, n) - x.place[which]
        step = x.k[item] + 1
        band = diagonal // step
        keys_item = np.concatenate((item, item))
        keys_band = np.concatenate((band, band - 1))  # a band spans two steps
        place = np.concatenate((x.place[which], x.place[which]))
        order = np.lexsort((place, keys_band, keys_item))
        i, b, p = keys_item[order], keys_band[order], place[order]
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1]) | (b[1:] != b[:-1])
        fresh = new.copy()
        fresh[1:] |= p[1:] != p[:-1]  # each q-gram of the item counts once in a band
        group = np.cumsum(new) - 1
        counts = np.bincount(group, weights=fresh).astype(np.int64)
        heads = np.flatnonzero(new)
        for g in np.flatnonzero(counts >= x.need[i[heads]]).tolist():
            j, lo = int(i[heads[g]]), int(b[heads[g]])
            k, m = int(x.k[j]), int(x.m[j])
            a = max(0, lo * (k + 1) - k)
            region = text[a : (lo + 2) * (k + 1) + m + 2 * k]
            if (got := align(x.texts[j], region, k)) is not None:
                yield j, (got[0], a + got[1], a + got[2])


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, q: int = 12, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, item_id, start, end, edits, item_chars): every occurrence of an item within its edit budget."""
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, start long, end long, edits int, item_chars int"

    def found_of(items: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast((items, q, rate))
        return docs.select(id_col, text_col).mapInArrow(lambda batches: run(batches, shared), schema)

    def run(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        scanner = Scanner(index)
        for b in chunks(batches, text_col, CHUNK):
            texts = [normal(t) for t in b.column(text_col).to_pylist()]
            found = scanner.scan(texts)
            if found:
                ids = b.column(id_col).to_pylist()
                cols = [[ids[f[0]] for f in found], [index.ids[f[1]] for f in found], [f[2] for f in found], [f[3] for f in found], [f[4] for f in found], [int(index.m[f[1]]) for f in found]]
                kinds = [to_arrow_type(id_type), to_arrow_type(item_type), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "start", "end", "edits", "item_chars"])

    out = None
    for items in _parts(benchmark, item_col, item_text_col):
        out = found_of(items) if out is None else out.unionByName(found_of(items))
    return out


def _parts(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in parts, at least one; equal items share a part."""
    items = benchmark.select(item_col, text_col).where(F.length(text_col) > 0)
    total = items.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = max(1, -(-total // PART_CHARS))
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64(item_col, text_col), F.lit(n)) == k).collect()]


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", q: int = 12, rate: float = 0.05, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which an item occurs; columns, repeated rows and their order within a file stay. What one
    part of the items leaves goes on to the next part within the same task."""

    def without(docs: DataFrame, items: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast((items, q, rate))
        return docs.mapInArrow(lambda batches: run(batches, shared), docs.schema)

    def run(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(Index(*shared.value))
        for b in chunks(batches, text_col, CHUNK):
            bad = {f[0] for f in scanner.scan([normal(t) for t in b.column(text_col).to_pylist()])}
            keep = pa.array([k not in bad for k in range(b.num_rows)])
            if (out := b.filter(keep)).num_rows:
                yield out

    for items in _parts(benchmark, item_col, item_text_col):
        docs = without(docs, items)
    return docs
