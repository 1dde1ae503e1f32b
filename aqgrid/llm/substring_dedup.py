"""Exact substring deduplication by super-k-mers of words.

A window is ``k`` words of one document; its minimiser is the least hash of its ``m``-word parts. Consecutive windows with
the same minimiser form a super-k-mer, which travels as one packed string to the bucket of its minimiser, so that equal
windows always meet and a word travels about three times instead of ``k`` times. In the bucket the windows are sorted and
each is told whether a document with a smaller id has it too; equality is that of the words, checked byte by byte.

Three things keep any bucket small. A task remembers the super-k-mers of its last chunks, and those that come back, with the
smallest id so far; an equal one of a larger id is answered at once and doesn't travel (this takes care of groups of copies
and of passages that are everywhere: of one passage about one string a task reaches its bucket). Minimisers that are frequent in the
corpus (a bounded list, counted over all documents first) come last in the order of minimisers, so that the windows around
a popular passage are dealt by their rarer parts. And the number of buckets follows from the size of the texts.

A word is removed if it lies in a window that also starts in a document with a smaller id; windows are those of the input.

Nulls: a null text has no words; a row with a null id takes no part and stays whole. Ids are a key: repeated rows (same id,
same text) each get the same answer and never remove each other, but rows with one id and different texts share the
removals of their id. Texts with fewer than k words have no window. Extra columns are not read; an empty table gives no
rows. Texts of any length are read whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqgrid.llm.common import Words, chunks, mix, utf8

#: Frequent minimisers that are put last; the list goes to every task.
MAX_FREQUENT = 4096
#: Text that one bucket gets on average.
BUCKET_BYTES = 2 << 20
#: Packed strings that a task holds before it sends them; larger parcels compress better.
HOLD_BYTES = 40 << 20
#: Super-k-mers in one of the two generations that a task remembers.
REMEMBERED = 120_000
#: Bytes up to which a parcel is sent as it is.
SMALL_PARCEL = 256
_LAST = np.uint64(1) << np.uint64(63)


def _ranked(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The order of minimisers: by hash, but frequent ones last."""
    h = hashes >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        h = np.where(frequent[at] == h, h | _LAST, h)
    return h


def _sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    size, out = 1, a
    while 2 * size <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(a) - w + 1], out[w - size :][: len(a) - w + 1]) if w > size else out


class SuperKmers:
    """The super-k-mers of some documents: document number, first word, windows, minimiser."""

    def __init__(self, words: Words, k: int, m: int, frequent: np.ndarray):
        n = words.n - k + 1
        if n <= 0:
            self.doc = self.first = self.windows = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        best = _sliding_min(_ranked(words.grams(m), frequent), k - m + 1)
        ok = np.flatnonzero(words.whole(k))
        if not len(ok):
            self.doc = self.first = self.windows = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        of, key = words.of[ok], best[ok]
        new = np.ones(len(ok), bool)
        new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1])
        heads = np.flatnonzero(new)
        self.doc = of[heads].astype(np.int64)
        self.key = key[heads]
        self.windows = np.diff(np.append(heads, len(ok)))
        self.first = ok[heads]


def _sorted_chunk(b: pa.RecordBatch, id_col: str, text_col: str) -> tuple[np.ndarray, list[bytes]]:
    ids = b.column(id_col).to_pylist()
    order = sorted((k for k, d in enumerate(ids) if d is not None), key=lambda k: ids[k])
    texts = utf8(b.column(text_col))
    return np.array([ids[k] for k in order], np.int64), [texts[k] for k in order]


def frequent_minimisers(docs: DataFrame, *, k: int, m: int, id_col: str, text_col: str) -> tuple[np.ndarray, int]:
    """The most frequent minimisers of all documents, at most ``MAX_FREQUENT``, and the bytes of text.

    A task reports those that make up a thousandth of a chunk's super-k-mers or more; the sums decide. The choice only
    balances the buckets, so any list gives the same result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text_col, 2 << 20):
            words = Words(utf8(b.column(text_col)))
            key, n = np.unique(SuperKmers(words, k, m, np.zeros(0, np.uint64)).key, return_counts=True)
            pick = n >= max(8, n.sum() // 1000)
            keys, counts = np.append(key[pick].astype(np.int64), -1), np.append(n[pick], len(words.buf))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["key", "n"])

    sums = docs.select(id_col, text_col).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rows = sums.orderBy(F.col("key") != -1, F.desc("n"), "key").limit(MAX_FREQUENT + 1).collect()
    size = next((r["n"] for r in rows if r["key"] == -1), 0)
    return np.sort(np.array([r["key"] for r in rows if r["key"] != -1], np.int64).view(np.uint64)), size


def _pack(doc: np.ndarray, first: np.ndarray, body: bytes, zstd: zstandard.ZstdCompressor) -> bytes:
    """A parcel; a first byte tells whether it is compressed, which small ones aren't."""
    data = struct.pack("<I", len(doc)) + doc.astype("<i8").tobytes() + first.astype("<i4").tobytes() + body
    return b"\1" + zstd.compress(data) if len(data) > SMALL_PARCEL else b"\0" + data


def _unpack(blob: bytes, zstd: zstandard.ZstdDecompressor, words: bool) -> tuple:
    data = zstd.decompress(blob[1:]) if blob[:1] == b"\1" else blob[1:]
    n = struct.unpack_from("<I", data)[0]
    at = 4 + 12 * n
    rest = data[at:].split(b"\n") if words else np.frombuffer(data, "<i4", n, at)
    return np.frombuffer(data, "<i8", n, 4), np.frombuffer(data, "<i4", n, 4 + 8 * n), rest


def removals(docs: DataFrame, *, k: int = 13, m: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, start, stop): words of a document that windows of documents with smaller ids cover, as intervals."""
    docs = docs.select(id_col, text_col)
    frequent, size = frequent_minimisers(docs, k=k, m=m, id_col=id_col, text_col=text_col)
    buckets = max(64, -(-size // BUCKET_BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed rows for the buckets: super-k-mers to count, and intervals that are known already."""
        out, seen, old = _Sender(buckets), {}, {}
        for b in chunks(batches, text_col, 2 << 20):
            ids, texts = _sorted_chunk(b, id_col, text_col)
            words = Words(texts)
            s = SuperKmers(words, k, m, shared.value)
            if not len(s.doc):
                continue
            buf = words.buf
            if len(seen) > REMEMBERED:
                seen, old = {}, seen
            begin, end = words.start[s.first], words.end[s.first + s.windows + k - 2]
            doc, first = ids[s.doc], s.first - words.first[s.doc]
            go, known = [], []
            strings = [buf[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
            for j, (w, d) in enumerate(zip(strings, doc.tolist(), strict=True)):
                least = seen.get(w)
                if least is None and (least := old.get(w)) is not None:
                    seen[w] = least
                if least is None or d < least:
                    seen[w] = d
                (known if least is not None and least < d else go).append(j)  # a smaller id has all these windows
            if known:
                out.known(*_merge(doc[known], first[known], first[known] + s.windows[known] + k - 1))
            out.put((mix(s.key[go]) % np.uint64(buckets)).astype(np.int64), doc[go], first[go], [strings[j] for j in go])
            if out.held >= HOLD_BYTES:
                yield from out.flush()
        yield from out.flush()

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        zstd = zstandard.ZstdDecompressor()
        known = [_unpack(x, zstd, False) for x in rows["packed"][rows["known"]]]
        got = [_unpack(x, zstd, True) for x in rows["packed"][~rows["known"]]]
        parts = [pd.DataFrame({"doc_id": g[0], "start": g[1], "stop": g[2]}) for g in known]
        if got:
            doc, first = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            parts.append(pd.DataFrame(duplicate_runs(doc, first, [w for g in got for w in g[2]], k), columns=["doc_id", "start", "stop"]))
        return pd.concat(parts)

    sent = docs.mapInArrow(send, "bucket int, known boolean, packed binary")
    return sent.groupBy("bucket").applyInPandas(count, "doc_id long, start int, stop int")


class _Sender:
    """Holds super-k-mers of several chunks by bucket, and packs them."""

    def __init__(self, buckets: int):
        self.buckets, self.zstd = buckets, zstandard.ZstdCompressor(level=5)
        self.parts: list[tuple] = []
        self.intervals: list[tuple] = []
        self.held = 0

    def put(self, bucket: np.ndarray, doc: np.ndarray, first: np.ndarray, strings: list[bytes]) -> None:
        self.parts.append((bucket, doc, first, strings))
        self.held += sum(map(len, strings)) + 64 * len(strings)

    def known(self, doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        self.intervals.append((doc, start, stop))

    def flush(self) -> Iterator[pa.RecordBatch]:
        """One parcel for each bucket that has strings; the work follows the strings held, however many buckets there are."""
        bucket, known, packed = [], [], []
        if self.parts:
            at, doc, first = (np.concatenate([p[c] for p in self.parts]) for c in range(3))
            order = np.argsort(at, kind="stable")
            at, doc, first = at[order], doc[order], first[order]
            every = [w for p in self.parts for w in p[3]]
            strings = [every[j] for j in order.tolist()]
            edges = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at)).tolist() if len(at) else []
            for x, y in zip(edges, edges[1:], strict=False):
                bucket.append(int(at[x]))
                known.append(False)
                packed.append(_pack(doc[x:y], first[x:y], b"\n".join(strings[x:y]), self.zstd))
        if self.intervals:  # any bucket will do; by the first document, so that they spread
            doc, start, stop = (np.concatenate([i[c] for i in self.intervals]) for c in range(3))
            for at in range(0, len(doc), 4096):
                bucket.append(int(mix(doc[at : at + 1].astype(np.uint64))[0] % np.uint64(self.buckets)))
                known.append(True)
                packed.append(_pack(doc[at : at + 4096], start[at : at + 4096], stop[at : at + 4096].astype("<i4").tobytes(), self.zstd))
        self.parts, self.intervals, self.held = [], [], 0
        if bucket:
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(known), pa.array(packed, pa.binary())], names=["bucket", "known", "packed"])


def _merge(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join intervals of a document that touch; the intervals are at least as long as their steps, or stay apart."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], np.maximum.reduceat(stop, heads)


def duplicate_runs(doc: np.ndarray, first: np.ndarray, strings: list[bytes], k: int) -> list[tuple[int, int, int]]:
    """Of the windows of some super-k-mers, those that a smaller document id has too, as runs (document, start, stop)."""
    words = Words(strings)
    ok = np.flatnonzero(words.whole(k))
    of = words.of[ok]
    d, hashes = doc[of], words.grams(k)[ok]
    order = np.lexsort((d, hashes))
    h = hashes[order]
    new = np.append(True, h[1:] != h[:-1])
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group]  # per sorted place: the window with the smallest document
    dup = d[order] > d[head]
    mine, theirs = order[dup], head[dup]
    if not len(mine):
        return []
    begin, end = words.start[ok], words.end[ok + k - 1]
    buf, equal = words.buf, np.ones(len(mine), bool)
    for j, (a, b, x, y) in enumerate(zip(begin[mine].tolist(), end[mine].tolist(), begin[theirs].tolist(), end[theirs].tolist(), strict=True)):
        if buf[a:b] != buf[x:y]:
            equal[j] = False
    if not equal.all():  # two different windows share a hash: sort their words instead
        mine = np.concatenate((mine[equal], _by_words(buf, begin, end, d, hashes, hashes[mine[~equal]], mine[equal])))
    start = first[of[mine]] + ok[mine] - words.first[of[mine]]
    d, a, z = _merge(d[mine], start, start + k)
    return list(zip(d.tolist(), a.tolist(), z.tolist(), strict=True))


def _by_words(buf: bytes, begin: np.ndarray, end: np.ndarray, doc: np.ndarray, hashes: np.ndarray, clash: np.ndarray, have: np.ndarray) -> np.ndarray:
    which = np.flatnonzero(np.isin(hashes, clash))
    least: dict[bytes, int] = {}
    for j in which.tolist():
        w = buf[begin[j] : end[j]]
        least[w] = min(least.get(w, int(doc[j])), int(doc[j]))
    out = [j for j in which.tolist() if doc[j] > least[buf[begin[j] : end[j]]]]
    return np.setdiff1d(np.array(out, np.int64), have)


def deduplicate(docs: DataFrame, *, k: int = 13, m: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_removed, text): what is left of each document, its words joined by single spaces."""
    runs = removals(docs, k=k, m=m, id_col=id_col, text_col=text_col)
    runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    joined = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = joined.hint("merge").join(runs, "doc_id", "left")  # the intervals grow with the input
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, limit=2 << 20):
            n_words, n_removed, kept = [], [], []
            for t, rs in zip(utf8(b.column("text")), b.column("runs").to_pylist(), strict=True):
                words = t.split()
                gone = np.zeros(len(words) + 1, np.int32)
                for r in rs or ():
                    gone[min(r["start"], len(words))] += 1
                    gone[min(r["stop"], len(words))] -= 1
                out = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g] if rs else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(out))
                kept.append(b" ".join(out).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    return joined.mapInArrow(cut, schema)


def digest(docs: DataFrame, **kw) -> DataFrame:
    """The digest that the query returns."""
    return deduplicate(docs, **kw).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))

