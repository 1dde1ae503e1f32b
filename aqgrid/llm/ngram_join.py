"""Exact Jaccard join on word shingles by T-occurrence search with DivideSkip, and the classes that its links form.

A document with n shingles links only with one that has T = ceil(0.75 n) of them or more. DivideSkip merges the inverted
lists of the document's rare shingles, keeps the documents that occur often enough there, and probes the lists of its
frequent shingles only for those. Here it runs twice.

Over the whole corpus, with all lists but the n - T + c rarest of a document left unmerged: any partner occurs at least c
times in the merged ones, on both sides, if all documents order shingles alike (c is 1 + 6 % of the size). The order is:
corpus-wide frequent shingles last (a bounded list, counted over all documents), else the longest first, as long ones are
rare; it is only a matter of speed. Lists travel packed by bucket. Short lists give counted pairs; a long list gives its
members, which stay if they occur in enough lists. What remains falls into groups that no link leaves. Of a list that is long
within one chunk already, only as many entries travel to its bucket as show that it is long; the other members stay where
they are dealt evenly, so that no task ever holds a popular list.

Then within each group, whole texts at hand, with true inverted lists, the split of DivideSkip between merged and probed
lists, and the exact test 100 |A n B| >= 75 |A u B|. Short lists are merged by a heap (by one count where they have more than
``HEAP_ENTRIES`` entries together, with the same outcome). The other lists are probed for all candidates at once, those that
hold a good part of the group as columns of bits, the rest by binary search in the sorted list of a term; candidates go as
soon as what is left to probe can't link them. A pair of different classes has an end outside the largest class, so only
documents there need a search: of many copies of one text these are the near misses, and each meets the whole group.

Equal sets are one node throughout: copies collapse within a chunk before anything travels and by their digest after it.
Groups larger than ``GROUP_SHINGLES`` are mostly texts that common phrases tie together, as the first order knows only the
most frequent shingles. Their shingles are counted within the group and the lists merged once more, now in the order of the
true counts, so that a text's merged lists are those of its rarest shingles; what remains falls into smaller groups.

A group that is still too large is searched in blocks, then by one representative of each block's classes, and at last the
documents outside its largest class are searched for in all blocks, so that every pair between different classes has been
looked at, while pairs within the largest are not all formed.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased. Fewer than five words: the whole sequence is one
shingle. Null or empty texts have no shingle and link with nothing. A null id takes no part; its row gets a null class.
Rows with one id are one node of the graph, each with the number of its own shingles. Extra columns are not read; an empty
table gives no rows; ties don't matter, as the class is named by its smallest id.
"""

from __future__ import annotations

import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqgrid.llm.common import STEP, Words, chunks, discard, mix, utf8, written
from aqgrid.llm.graph import components

#: Frequent shingles that are put last; the list goes to every task.
MAX_FREQUENT = 1 << 16
#: Lists up to this length give pairs.
SHORT_LIST = 32
#: Shingles of the documents that one task searches at once.
GROUP_SHINGLES = 2_000_000
#: Entries of merged lists up to which a heap merges them.
HEAP_ENTRIES = 4096
#: Lists of one document in so many of a group, or more, are kept as bits, too.
DENSE = 32
#: Text that one bucket of lists stands for.
BUCKET_BYTES = 16 << 20
#: Entries of short lists that one bucket of a large group holds.
BUCKET_ENTRIES = 1 << 18
_LAST = np.uint64(1) << np.uint64(63)


class Shingles:
    """Distinct shingles of some texts: document number, hash and size in bytes, sorted by document and hash."""

    def __init__(self, texts: list[bytes], k: int):
        w = Words([t.lower() for t in texts])  # bytes.lower() changes A-Z only
        ok = np.flatnonzero(w.whole(k))
        doc, h = w.of[ok].astype(np.int64), w.grams(k)[ok]
        size = w.end[ok + k - 1] - w.start[ok] if len(ok) else np.zeros(0, np.int64)
        few = np.flatnonzero((w.counts > 0) & (w.counts < k))
        if len(few):
            n, first = w.counts[few], w.first[few]
            hs = np.zeros(len(few), np.uint64)
            for j in range(k - 1):
                hs += np.where(n > j, w.hash[np.minimum(first + j, w.n - 1)] * STEP[j], np.uint64(0))
            doc, h = np.concatenate((doc, few)), np.concatenate((h, mix(hs + n.astype(np.uint64) * STEP[50])))
            size = np.concatenate((size, w.end[first + n - 1] - w.start[first]))
        order = np.lexsort((h, doc))
        doc, h, size = doc[order], h[order], size[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        self.doc, self.hash, self.size = doc[new], h[new], size[new]
        self.n = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each document's set, whatever the order: sums of two hashes of its members."""
        out = []
        for salt in (STEP[51], STEP[52]):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.hash ^ salt))))
            out.append(mix(sums[self.first + self.n] - sums[self.first]).view(np.int64))
        return out[0], out[1]

    def ranked(self, frequent: np.ndarray) -> np.ndarray:
        """The order of shingles: frequent ones last, else long ones first, then by hash."""
        r = ((np.uint64(255) - np.minimum(self.size, 255).astype(np.uint64)) << np.uint64(55)) | (self.hash >> np.uint64(9))
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, r), len(frequent) - 1)
            r = np.where(frequent[at] == r, r | _LAST, r)
        return r


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """T: the least overlap of a document of n shingles with any partner."""
    return -(-percent * n // 100)


def shared_rare(n):
    """c: how often a partner occurs in the merged lists at least; for numbers, arrays and columns."""
    return 1 + (F.floor(n * 6 / 100) if isinstance(n, Column) else n * 6 // 100)


def profiles(docs: DataFrame, *, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row a document (doc_id, n, k1, k2), and rows of frequent shingles (token, count) and of text size (count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text_col, 2 << 20):
            texts = utf8(b.column(text_col))
            s = Shingles(texts, k)
            k1, k2 = s.keys()
            n = len(texts)
            once = np.zeros(n, bool)
            once[np.unique(k1, return_index=True)[1]] = True
            token, count = np.unique(s.ranked(np.zeros(0, np.uint64))[once[s.doc]], return_counts=True)
            token, count = token[count >= 8], count[count >= 8]
            m = len(token) + 1
            kind = np.array([0] * n + [1] * (m - 1) + [2], np.int8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kind),
                    pa.concat_arrays([b.column(id_col).cast(pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.array(np.concatenate((s.n, np.zeros(m, np.int64)))),
                    pa.array(np.concatenate((k1, token.view(np.int64), [0]))),
                    pa.array(np.concatenate((k2, count, [sum(map(len, texts))]))),
                ],
                names=["kind", "doc_id", "n", "k1", "k2"],
            )

    return written(docs.select(id_col, text_col).mapInArrow(run, "kind byte, doc_id long, n long, k1 long, k2 long"), "profiles")


def rare_lists(docs: DataFrame, frequent: np.ndarray, size: int, *, k: int, percent: int, id_col: str, text_col: str, short_list: int = SHORT_LIST) -> DataFrame:
    """The merged lists: counted pairs of the short ones (kind 0: a, b, na, nb, count), members of the long ones (kind 1: a
    the list, b the set, na its size). Sets are named by the first half of their digest."""
    buckets = max(64, -(-size // BUCKET_BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=1)
        for b in chunks(batches, text_col, 2 << 20):
            if b.column(id_col).null_count:
                b = b.filter(pc.is_valid(b.column(id_col)))
            s = Shingles(utf8(b.column(text_col)), k)
            if not len(s.doc):
                continue
            k1, _ = s.keys()
            once = np.zeros(len(k1), bool)
            once[np.unique(k1, return_index=True)[1]] = True
            rank = s.ranked(shared.value)
            order = np.lexsort((rank, s.doc))
            place = np.arange(len(order)) - s.first[s.doc]
            take = s.n - needed(s.n, percent) + shared_rare(s.n)
            keep = (place < take[s.doc]) & once[s.doc]
            token, doc = mix(rank[order][keep]), s.doc[keep]
            bucket = (((token >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(token, kind="stable")  # buckets are ranges of tokens
            token, doc, bucket = token[order], doc[order], bucket[order]
            head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            more = np.arange(len(token)) - np.repeat(head, np.diff(np.append(head, len(token)))) > short_list
            key, known, blobs = [], [], []
            if more.any():
                t, d = token[more], doc[more]
                for at in range(0, len(t), 4096):
                    x = slice(at, at + 4096)
                    key.append(int(mix(t[x][:1] ^ k1[d[x][:1]].view(np.uint64))[0] % np.uint64(buckets)))
                    known.append(True)
                    blobs.append(zstd.compress(np.concatenate((t[x].view(np.int64), k1[d[x]], s.n[d[x]])).astype("<i8").tobytes()))
                token, doc, bucket = token[~more], doc[~more], bucket[~more]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                local, ref = np.unique(doc[x:y], return_inverse=True)
                head = struct.pack("<II", len(local), y - x) + k1[local].astype("<i8").tobytes() + s.n[local].astype("<i8").tobytes()
                key.append(int(bucket[x]))
                known.append(False)
                blobs.append(zstd.compress(head + token[x:y].astype("<u8").tobytes() + ref.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(known), pa.array(blobs, pa.binary())], names=["bucket", "known", "packed"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        zstd = zstandard.ZstdDecompressor()
        tokens, sets, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for blob in rows["packed"][~rows["known"]]:
            data = zstd.decompress(blob)
            m, n = struct.unpack_from("<II", data)
            at = 8 + 16 * m
            tokens.append(np.frombuffer(data, "<u8", n, at))
            ref = np.frombuffer(data, "<u4", n, at + 8 * n)
            sets.append(np.frombuffer(data, "<i8", m, 8)[ref])
            sizes.append(np.frombuffer(data, "<i8", m, 8 + 8 * m)[ref])
        parts = [merge_lists(np.concatenate(tokens), np.concatenate(sets), np.concatenate(sizes), percent, short_list)]
        for blob in rows["packed"][rows["known"]]:
            a, b, n = np.frombuffer(zstd.decompress(blob), "<i8").reshape(3, -1)
            parts.append(pd.DataFrame({"kind": np.int8(1), "a": a, "b": b, "na": n, "nb": 0, "count": 1}))
        return pd.concat(parts)

    schema = "kind byte, a long, b long, na long, nb long, count long"
    sent = docs.select(id_col, text_col).mapInArrow(send, "bucket int, known boolean, packed binary")
    return sent.groupBy("bucket").applyInPandas(merge, schema)


def merge_lists(token: np.ndarray, sets: np.ndarray, sizes: np.ndarray, percent: int, short_list: int) -> pd.DataFrame:
    """Lists of one bucket: counted pairs of the short ones, members of the long ones."""
    if not len(token):
        return pd.DataFrame({c: pd.Series(dtype=np.int8 if c == "kind" else np.int64) for c in ("kind", "a", "b", "na", "nb", "count")})
    order = np.lexsort((sets, token))
    token, sets, sizes = token[order], sets[order], sizes[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (sets[1:] != sets[:-1])
    token, sets, sizes = token[new], sets[new], sizes[new]
    head = np.append(True, token[1:] != token[:-1])
    group = np.cumsum(head) - 1
    length = np.bincount(group)[group]
    long = length > short_list
    short = (length > 1) & ~long
    t, s, n = token[short], sets[short], sizes[short]
    names, ref = np.unique(s, return_inverse=True)
    pairs = []
    for step in range(1, short_list):
        same = t[step:] == t[:-step]
        x, y = n[:-step][same], n[step:][same]
        near = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        pairs.append(ref[:-step][same][near] * len(names) + ref[step:][same][near])
    pair, count = np.unique(np.concatenate(pairs), return_counts=True) if len(names) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    size_of = np.zeros(len(names), np.int64)
    size_of[ref] = n
    i, j = (pair // len(names), pair % len(names)) if len(names) else (pair, pair)
    lists = token[long].view(np.int64)
    m = int(long.sum())
    return pd.DataFrame(
        {
            "kind": np.repeat(np.array([0, 1], np.int8), [len(pair), m]),
            "a": np.concatenate((names[i], lists)),
            "b": np.concatenate((names[j], sets[long])),
            "na": np.concatenate((size_of[i], sizes[long])),
            "nb": np.concatenate((size_of[j], np.zeros(m, np.int64))),
            "count": np.concatenate((count, np.ones(m, np.int64))),
        }
    )


def groups(lists: DataFrame, percent: int) -> DataFrame:
    """Rows (node: set, component: group): the sets that may link, in groups that no link leaves."""
    pairs = lists.where("kind = 0").groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("count").alias("count"))
    long = lists.where("kind = 1").select(F.col("a").alias("list"), F.col("b").alias("node"), F.col("na").alias("n")).distinct()
    in_long = long.groupBy("node").agg(F.count("*").alias("long"), F.first("n").alias("n"))
    pairs = written(pairs, "pairs")
    # a pair stays if its short lists, and all long ones that both might share, reach c
    a = in_long.select(F.col("node").alias("a"), F.col("long").alias("la"))
    b = in_long.select(F.col("node").alias("b"), F.col("long").alias("lb"))
    may = pairs.join(a, "a", "left").join(b, "b", "left")
    common = F.least(F.coalesce("la", F.lit(0)), F.coalesce("lb", F.lit(0)))
    may = may.where(F.col("count") + common >= shared_rare(F.least("na", "nb"))).select("a", "b")
    # a pair without a common short list has c long ones in common: members of fewer, even for their smallest partner, go
    least = shared_rare(F.ceil(F.col("n") * percent / 100))
    live = in_long.where(F.col("long") >= least).select("node")
    members = long.join(live, "node", "left_semi").select("list", "node")
    members = written(members, "members")
    hubs = written(members.groupBy("list").agg(F.min("node").alias("hub")), "hubs")  # so that Spark may split a hot list in the join
    stars = members.join(hubs, "list").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    out = written(components(may.union(stars)), "groups")
    discard(pairs, members, hubs)
    return out


def named_sets(rows: DataFrame, k: int) -> DataFrame:
    """Rows (grp, id, n, node, text): each text with its number of shingles and the name of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 2 << 20):
            s = Shingles(utf8(b.column("text")), k)
            columns = [b.column("grp"), b.column("id"), pa.array(s.n), pa.array(s.keys()[0]), b.column("text")]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "id", "n", "node", "text"])

    return rows.select("grp", "id", "text").mapInArrow(run, "grp long, id long, n long, node long, text string")


def counted_lists(sets: DataFrame, *, k: int, percent: int, short_list: int) -> DataFrame:
    """As ``rare_lists``, within the groups of ``named_sets``, with shingles ordered by how many texts of the group have them."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 2 << 20):
            s = Shingles(utf8(b.column("text")), k)
            of = pa.array(s.doc)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(of) for c in ("grp", "node", "n")), pa.array(s.hash.view(np.int64))], names=["grp", "node", "n", "token"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return merge_lists(rows["token"].to_numpy().view(np.uint64), rows["node"].to_numpy(), rows["n"].to_numpy(), percent, short_list)

    every = sets.select("grp", "node", "n", "text").mapInArrow(tokens, "grp long, node long, n long, token long")
    # a shingle that one text has alone comes first in the order and has no list
    shared = every.groupBy("grp", "token").agg(F.count("*").alias("often")).where("often > 1")
    from_end = F.row_number().over(Window.partitionBy("grp", "node").orderBy(F.desc("often"), F.desc("token")))
    left = F.ceil(F.col("n") * percent / 100) - shared_rare(F.col("n"))
    kept = every.join(shared, ["grp", "token"]).withColumn("from_end", from_end).where(F.col("from_end") > left)
    kept = written(kept.select(F.xxhash64("grp", "token").alias("token"), "node", "n", "often"), "counted")
    short = kept.where(F.col("often") <= short_list)
    buckets = max(64, -(-short.count() // BUCKET_ENTRIES))
    dealt = short.withColumn("bucket", F.pmod("token", F.lit(buckets))).select("bucket", "token", "node", "n")
    pairs = dealt.groupBy("bucket").applyInPandas(merge, "kind byte, a long, b long, na long, nb long, count long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    long = kept.where(F.col("often") > short_list)
    long = long.select(F.lit(1).cast("byte").alias("kind"), F.col("token").alias("a"), F.col("node").alias("b"), F.col("n").alias("na"), zero.alias("nb"), one.alias("count"))
    out = written(pairs.union(long), "lists")
    discard(kept)
    return out


def regrouped(rows: DataFrame, *, k: int, percent: int, short_list: int) -> DataFrame:
    """Cut large groups (grp, id, text) into those that lists in the order of true counts leave: rows (grp, id, n, text, total),
    with the shingles of the new group; texts that can't link with any other are gone."""
    sets = written(named_sets(rows, k), "large")
    lists = counted_lists(sets, k=k, percent=percent, short_list=short_list)
    grouped = groups(lists, percent).withColumnRenamed("component", "grp")
    total = sets.select("node", "n").join(grouped, "node").groupBy("grp").agg(F.sum("n").alias("total"))
    out = written(sets.drop("grp").hint("merge").join(grouped.join(total, "grp"), "node").select("grp", "id", "n", "text", "total"), "regrouped")
    discard(sets, lists, grouped)
    return out


def divide_skip(n: int, longest: int, need: int) -> int:
    """How many of the longest lists are probed instead of merged."""
    return max(0, min(need - 1, int(need / (0.0085 * np.log2(max(2, longest)) + 1))))


class Search:
    """T-occurrence search over some documents; finds links between different classes only."""

    def __init__(self, texts: list[bytes], k: int, percent: int):
        s = Shingles(texts, k)
        self.percent, self.n = percent, s.n
        self.first = s.first
        order = np.argsort(s.hash, kind="stable")  # stable: each list is sorted by document
        h = s.hash[order]
        head = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        self.begin, self.until = head, np.append(head[1:], len(h))
        self.lists = s.doc[order]
        size = self.until - self.begin
        of = np.repeat(np.arange(len(head)), size)
        self.entries = of * len(texts) + self.lists  # all lists one after the other, each sorted by document
        term = np.empty(len(h), np.int64)
        term[order] = of
        self.term = term  # of each document the terms; sorted, as they are numbered by hash
        # a list of one document in DENSE or more is a column of bits, too: DENSE bits an entry at most
        dense = (size > 1) & (size * DENSE >= len(texts))
        self.column = np.where(dense, np.cumsum(dense) - 1, -1)
        self.bits = np.zeros((len(texts), -(-int(dense.sum()) // 64)), np.uint64)
        at = np.flatnonzero(dense[of])
        column = self.column[of[at]]
        np.bitwise_or.at(self.bits.reshape(-1), self.lists[at] * self.bits.shape[1] + (column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))

    def terms(self, d: int) -> np.ndarray:
        return self.term[self.first[d] : self.first[d] + self.n[d]]

    def merge(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that occur in at least ``least`` of the lists of some terms, and how often."""
        begin, count = self.begin[terms], self.until[terms] - self.begin[terms]
        entries = int(count.sum())
        if entries <= HEAP_ENTRIES:
            heap = heapq.merge(*[self.lists[a:b].tolist() for a, b in zip(begin.tolist(), (begin + count).tolist(), strict=True)])
            runs = [(c, often) for c, run in itertools.groupby(heap) if (often := sum(1 for _ in run)) >= least]
            found, often = np.array(runs, np.int64).reshape(-1, 2).T
            return found, often
        docs = self.lists[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(entries)]
        if entries * 8 < len(self.n):
            found, often = np.unique(docs, return_counts=True)
            return found[often >= least], often[often >= least]
        often = np.bincount(docs, minlength=len(self.n))
        found = np.flatnonzero(often >= least)
        return found, often[found]

    def partners(self, q: int, wanted, label: np.ndarray | None = None) -> Iterator[int]:
        """Documents that link with q, of those with another ``label`` that ``wanted`` (asked once and again, as classes grow)
        lets pass. Candidates are dropped, all at once, when what is left to probe can't link them any more."""
        n = int(self.n[q])
        if not n:
            return
        need = int(needed(np.int64(n), self.percent))
        terms = self.terms(q)
        size = self.until[terms] - self.begin[terms]
        if int((size > 1).sum()) < need:  # too many shingles that no other document has
            return
        order = np.argsort(size, kind="stable")
        probed = divide_skip(n, int(size.max()), need)
        merged, rest = terms[order[: n - probed]], np.sort(terms[order[n - probed :]])
        found, have = self.merge(merged, need - probed)
        m = self.n[found]

        def may(left: int) -> np.ndarray:
            return (100 + self.percent) * (have + left) >= self.percent * (n + m)

        keep = (found != q) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)) & may(len(rest))
        if label is not None:
            keep &= label[found] != label[q]
        found, have, m = found[keep], have[keep], m[keep]
        column = self.column[rest]
        dense, rest = column[column >= 0], rest[column < 0]
        if len(dense) and len(found):  # probe the long lists of these terms for all candidates
            mask = np.zeros(self.bits.shape[1], np.uint64)
            np.bitwise_or.at(mask, dense >> 6, np.uint64(1) << (dense & 63).astype(np.uint64))
            at = np.flatnonzero(mask)
            step = max(1, (1 << 20) // len(at))
            for x in range(0, len(found), step):
                have[x : x + step] += np.bitwise_count(self.bits[found[x : x + step, None], at] & mask[at]).sum(axis=1, dtype=np.int64)
            keep = may(len(rest))
            found, have, m = found[keep], have[keep], m[keep]
        if len(rest) and len(found):  # and the others by binary search
            step = max(1, (1 << 20) // len(rest))
            for x in range(0, len(found), step):
                wanted_entries = rest * len(self.n) + found[x : x + step, None]
                at = np.minimum(np.searchsorted(self.entries, wanted_entries), len(self.entries) - 1)
                have[x : x + step] += (self.entries[at] == wanted_entries).sum(axis=1)
        for c in found[may(0)].tolist():
            if wanted(c):
                yield c


class Forest:
    """Classes, each with a label that all its members have, and the label of the largest of them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = [[x] for x in range(n)]
        self.largest = 0

    def size(self, x: int) -> int:
        return len(self.members[self.label[x]])

    def apart(self, x: int, y: int) -> bool:
        return self.label[x] != self.label[y]

    def join(self, x: int, y: int) -> None:
        x, y = sorted((int(self.label[x]), int(self.label[y])), key=lambda c: len(self.members[c]))
        if x != y:  # the members of the smaller class take the label of the larger one
            self.label[self.members[x]] = y
            self.members[y] += self.members[x]
            self.members[x] = []
        if len(self.members[y]) > len(self.members[self.largest]):
            self.largest = y


def search_group(ids: list[int], texts: list[bytes], k: int, percent: int, query: list[bool] | None = None, classes: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (id, id) that join the classes of some documents; with ``query``, only the marked documents are searched for,
    else those outside the largest class until there is none left."""
    search, forest = Search(texts, k, percent), Forest(len(ids))
    if classes is not None:
        first: dict[int, int] = {}
        for j, c in enumerate(classes):
            forest.join(j, first.setdefault(c, j))
    out: list[tuple[int, int]] = []

    def ask(q: int) -> None:
        for c in search.partners(q, lambda c: forest.apart(c, q), forest.label):
            forest.join(c, q)
            out.append((ids[q], ids[c]))

    if query is not None:
        for q in range(len(ids)):
            if query[q]:
                ask(q)
        return out
    waiting = list(range(len(ids)))
    while waiting:
        later = []
        for q in waiting:
            if forest.size(q) > 1 and forest.label[q] == forest.largest:
                later.append(q)  # all others may come to it instead
            else:
                ask(q)
        if len(later) == len(waiting):
            break
        waiting = [q for q in later if forest.label[q] != forest.largest]
    return out


def _links(rows: DataFrame, keys: list[str], k: int, percent: int) -> DataFrame:
    """Search every group of rows (keys, id, text, and maybe query and class) on its own; rows (a, b)."""
    cross = "query" in rows.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        texts = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
        out = search_group(pdf["id"].tolist(), texts, k, percent, *((pdf["query"].tolist(), pdf["class"].tolist()) if cross else ()))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.groupBy(*keys).applyInPandas(run, "a long, b long")


def _large_links(rows: DataFrame, k: int, percent: int, limit: int) -> DataFrame:
    """Links within groups that are too large for one task; rows (grp, id, n, text)."""
    total = rows.groupBy("grp").agg(F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("total") / limit), F.lit(1)).cast("int")
    dealt = rows.join(total, "grp").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).drop("total")
    dealt = written(dealt, "blocks")
    links = written(_links(dealt, ["grp", "block"], k, percent), "links")
    links = written(links.union(_representative_links(dealt, links, k, percent, limit)), "links")
    # every pair of different classes has an end outside the largest class of its group
    classed = _classed(dealt, links)
    sums = classed.groupBy("grp", "class").agg(F.sum("n").alias("s")).groupBy("grp").agg(F.max_by("class", F.struct("s", "class")).alias("largest"))
    classed = classed.join(sums, "grp")
    asked = classed.where("class <> largest")
    parts = asked.groupBy("grp").agg(F.greatest(F.ceil(F.sum("n") / limit), F.lit(1)).alias("parts"))
    asked = asked.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    index = classed.join(parts, "grp").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pick = lambda d, query: d.select("grp", "block", "part", "id", "text", F.lit(query).alias("query"), "class")
    return links.union(_links(pick(asked, True).union(pick(index, False)), ["grp", "block", "part"], k, percent))


def _classed(rows: DataFrame, links: DataFrame) -> DataFrame:
    named = components(links).select(F.col("node").alias("id"), F.col("component").alias("class"))
    return rows.join(named, "id", "left").withColumn("class", F.coalesce("class", "id"))


def _representative_links(rows: DataFrame, links: DataFrame, k: int, percent: int, limit: int) -> DataFrame:
    """Search one document of each class; blocks' classes of one large group of near copies meet here."""
    heads = _classed(rows, links).where("id = class").select("grp", "id", "n", "text")
    total = heads.groupBy("grp").agg(F.sum("n").alias("total"))
    heads = heads.join(total, "grp").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("total") / limit)))
    return _links(heads.drop("total"), ["grp", "block"], k, percent)


def ngram_join(docs: DataFrame, *, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", group_shingles: int = GROUP_SHINGLES, short_list: int = SHORT_LIST) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): the class of each document under links of Jaccard >= percent / 100."""
    prof = profiles(docs, k=k, id_col=id_col, text_col=text_col)
    size = prof.where("kind = 2").agg(F.sum("k2")).first()[0] or 0
    top = prof.where("kind = 1").groupBy("k1").agg(F.sum("k2").alias("s")).orderBy(F.desc("s"), "k1").limit(MAX_FREQUENT).collect()
    frequent = np.sort(np.array([r["k1"] for r in top], np.int64).view(np.uint64))
    rows = prof.where("kind = 0").select("doc_id", "n", "k1", "k2")
    sets = rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("head")).where("head IS NOT NULL")
    lists = written(rare_lists(docs, frequent, size, k=k, percent=percent, id_col=id_col, text_col=text_col, short_list=short_list), "lists")
    grouped = groups(lists, percent)
    chosen = sets.join(grouped.withColumnsRenamed({"node": "k1", "component": "grp"}), "k1").select("head", "n", "grp")
    total = chosen.groupBy("grp").agg(F.sum("n").alias("total"))
    chosen = written(chosen.join(total, "grp"), "chosen")
    discard(lists, grouped)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    picked = texts.hint("merge").join(chosen.withColumnRenamed("head", "id"), "id")  # what is chosen grows with the input
    large = not chosen.where(F.col("total") > group_shingles).isEmpty()
    if large:
        picked = written(picked, "picked")  # so that the texts travel once for groups of either kind
    links = _links(picked.where(F.col("total") <= group_shingles).select("grp", "id", "text"), ["grp"], k, percent)
    if large:
        cut = regrouped(picked.where(F.col("total") > group_shingles), k=k, percent=percent, short_list=short_list)
        links = links.union(_links(cut.where(F.col("total") <= group_shingles).select("grp", "id", "text"), ["grp"], k, percent))
        cut = cut.where(F.col("total") > group_shingles).drop("total")
        if not cut.isEmpty():
            links = links.union(_large_links(cut, k, percent, group_shingles))
    links = written(links, "links")
    if large:
        discard(picked)
    named = components(links).withColumnsRenamed({"node": "head", "component": "linked"})
    classes = sets.join(named, "head", "left").select("k1", "k2", F.coalesce("linked", "head").alias("class"))
    # the smallest id of a class is its smallest head, as heads are the smallest ids of equal sets
    out = rows.join(classes, ["k1", "k2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("component_id"))
