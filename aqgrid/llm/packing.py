"""Harmonic packing of token sequences.

Class k holds the pieces of length at most capacity / k and more than capacity / (k + 1); a bin of class k takes k pieces,
whatever they are, so a worker fills bins from the counts alone and no two workers need to talk. A document longer than
the capacity gives whole bins first. A rest that would waste much of its slot is cut at the next reciprocal (capacity /
(k + 1), a piece that fits its slot exactly), at most ``max_cuts`` times, so that padding stays small.

Each task leaves at most k - 1 pieces of each class. They meet in groups of ``GATHER`` tasks, where bins of one class are
filled first and what is left, again fewer than k of each class, is packed across classes, largest first, into the first
bin that has room. A group's size is bounded by ``GATHER`` and the capacity, not by the data.

Tokens are made part by part with a bounded cache: the tokenizer splits at white space and by its pattern, so the ids of a
text are those of its parts, one after the other. The cache belongs to the task and ends with it.

Nulls: a null text is empty and gives the end id alone; a null id is passed on. Repeated rows are packed each on its own.
Only the id and text columns are read, so others can't clash. An empty table gives no rows. A text of any length is
tokenized whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqgrid.llm.common import chunks, written

#: Tasks whose left-over pieces meet.
GATHER = 4
_COLUMNS = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, task int"


#: Text that the tokenizer's normaliser only lower-cases and whose parts the pattern below finds as the tokenizer does.
_SIMPLE = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\n a-zß-öø-ÿ0-9]+")
_ASCII_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPACE = re.compile(r"[\n ]")
#: Parts of words in one generation of the cache.
GENERATION = 200_000
#: Characters that are tokenized in one step.
STEP = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Known(dict):
    """Ids by part, a bounded cache in two generations: when the young one is full it becomes the old one, and what is asked
    for again comes back from there, so that frequent parts outlive the others."""

    def __init__(self, find: Callable[[str], bytes], most: int):
        super().__init__()
        self.find, self.most, self.old = find, most, {}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(part)
        if ids is None:
            ids = self.find(part)
        self[part] = ids
        return ids


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers, by a bounded cache of the parts of words.

    The tokenizer drops white space, so the ids of a text are those of its space-separated words, one after the other. Text
    of ASCII and Latin-1 letters is cut as the tokenizer's own pattern does and its parts go to the tokenizer's model
    straight away; any other word, or any word if the tokenizer is of another make, goes through the whole tokenizer.
    """

    def __init__(self, path: str, generation: int = GENERATION):
        self.tokenizer, self.straight, self.special = _loaded(path)
        self.letters = _byte_letters()
        self.parts, self.words = _Known(self._part, generation), _Known(self._word, generation)

    def encode(self, text: str | None) -> bytes:
        return b"".join([self._encode(x) for x in steps(text or "")])

    def _encode(self, text: str) -> bytes:
        if self._is_simple(text):
            return self._simple(text)
        out, run = [], []
        for w in _SPACE.split(text):
            if self._is_simple(w):
                run.append(w)
                continue
            out += [self._simple(" ".join(run)), self.words[w]]
            run = []
        return b"".join([*out, self._simple(" ".join(run))])

    def _is_simple(self, text: str) -> bool:
        return self.straight and _SIMPLE.fullmatch(text) is not None and not ("<" in text and any(x in text for x in self.special))

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _PART.findall(text.lower())))

    def _part(self, part: str) -> bytes:
        found = self.tokenizer.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(found)}I", *[x.id for x in found])

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()


def steps(text: str) -> Iterator[str]:
    """The text in pieces of about ``STEP`` characters that end before a space or line end, or where the text does."""
    at = 0
    while len(text) - at > STEP:
        m = _SPACE.search(text, at + STEP)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


@lru_cache(maxsize=1)
def _loaded(path: str) -> tuple:
    """A worker's tokenizer, whether its parts are those of the pattern, and its special tokens; without any cache of ids."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    straight = _made_of(made) == ["NFC", "Replace", "Lowercase", _ASCII_PATTERN, "ByteLevel"]
    return Tokenizer.from_file(path), straight, tuple(x["content"] for x in made.get("added_tokens", []))


def _made_of(made: dict) -> list[str]:
    steps = [x["type"] for x in (made.get("normalizer") or {}).get("normalizers", [])]
    for x in (made.get("pre_tokenizer") or {}).get("pretokenizers", []):
        steps.append(x["pattern"].get("Regex", "") if x["type"] == "Split" else x["type"])
    return steps


def cut(n: int, capacity: int, max_cuts: int = 3) -> list[tuple[int, int]]:
    """(length, class) of the pieces of ``n`` tokens, in order."""
    out = [(capacity, 1)] * (n // capacity)
    r = n % capacity
    cuts = 0
    while r:
        k = capacity // r
        waste = capacity // k - r
        exact = capacity // (k + 1)
        if cuts >= max_cuts or waste <= max(8, r // 50) or exact < 16 or r == exact:
            out.append((r, k))
            break
        out.append((exact, k + 1))
        r -= exact
        cuts += 1
    return out


class Bins:
    """Open bins, one a class; a full one is emitted with its number."""

    def __init__(self, base: int):
        self.base = base
        self.used = 0
        self.open: dict[int, list[tuple]] = {}

    def put(self, k: int, piece: tuple) -> list[tuple] | None:
        """Take a piece (its length comes third); give the rows of a bin if it is full now."""
        b = self.open.setdefault(k, [])
        b.append(piece)
        if len(b) < k:
            return None
        del self.open[k]
        return self.close(b)

    def close(self, pieces: list[tuple]) -> list[tuple]:
        seq, at, out = self.base + self.used, 0, []
        self.used += 1
        for p in pieces:
            out.append((*p, seq, at))
            at += p[2]
        return out


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", max_cuts: int = 3) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one a piece; see the module.

    Every id of a document, the end id included, lies in one piece. Sequence ids are unique and not dense. Sequences of
    fewer than ``capacity`` ids are to be padded; if their length is a power of two, they may stay as they are.
    """
    id_type = docs.schema[id_col].dataType
    schema = _COLUMNS.format(id=id_type.simpleString())
    end = np.array([end_id], "<u4").tobytes()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        encoder, task = WordEncoder(tokenizer_path), TaskContext.get().partitionId()  # its caches end with the task
        bins = Bins((task * 2) << 31)
        for b in chunks(batches, text_col, STEP):
            rows: list[tuple] = []
            for d, text in zip(b.column(id_col).to_pylist(), b.column(text_col).to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                start, total = 0, len(ids) // 4
                for size, k in cut(total, capacity, max_cuts):
                    full = bins.put(k, (d, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), total))
                    if full:
                        rows += full
                    start += size
            if rows:
                yield _batch(rows, task, id_type)
        left = [(*p, None, None) for ps in bins.open.values() for p in ps]
        if left:
            yield _batch(left, task, id_type)

    pieces = written(docs.select(id_col, text_col).mapInArrow(fill, schema), "packing")

    def gather(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "task", "doc_id", "start"], ascending=[False, True, True, True], kind="stable")
        bins, rows = Bins((int(key[0]) * 2 + 1) << 31), []
        for p in left[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False, name=None):
            rows += bins.put(capacity // p[2], p) or []
        rest = sorted((p for ps in bins.open.values() for p in ps), key=lambda p: -p[2])
        for b in first_fit([p[2] for p in rest], capacity):
            rows += bins.close([rest[i] for i in b])
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return out.assign(task=0)

    full = pieces.where(F.col("sequence_id").isNotNull())
    left = pieces.where(F.col("sequence_id").isNull()).groupBy((F.col("task") / GATHER).cast("int").alias("g")).applyInPandas(gather, schema)
    return full.unionByName(left).drop("task").withColumnRenamed("doc_id", id_col)


def first_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices by bin; each size goes to the first bin with room. A tree of the largest rooms finds it in log n."""
    n = 1
    while n < max(1, len(sizes)):
        n *= 2
    room = [capacity] * (2 * n)
    out: list[list[int]] = []
    for i, s in enumerate(sizes):
        k = 1
        while k < n:
            k = 2 * k if room[2 * k] >= s else 2 * k + 1
        b = k - n
        while len(out) <= b:
            out.append([])
        out[b].append(i)
        room[k] -= s
        while k > 1:
            k //= 2
            room[k] = max(room[2 * k], room[2 * k + 1])
    return out


def _batch(rows: list[tuple], task: int, id_type) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    cols = list(zip(*rows, strict=True))
    kinds = [to_arrow_type(id_type), *[pa.int64()] * 6]
    arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)] + [pa.array(np.full(len(rows), task, np.int32))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task"])
