"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts every substring of that text. A document is parsed greedily:
the longest match at the current place is a phrase, and the next phrase starts where it ends. Text in the automaton's
language needs few phrases. The counts are normalised by the length parsed and by the phrases per character that the
language's own held-back text needs; the language with the fewest wins.

The automata come from a bounded sample: at most ``sample_chars`` characters a language, from texts picked by their hash; of
a long text a window. Every label is learned, and every letter of the sample has a class of its own. The driver builds the
automata, and their transitions travel with the task (about 36 bytes for each sampled character); a task lays out its tables
from them, parses many pieces in step with numpy and drops the tables at its end. A document is cut into pieces of ``PIECE``
characters, each parsed on its own; every piece counts. Pieces are made and parsed ``SLICE`` characters at a time, so that
beside the text itself the longest one takes no more memory than a short one. More than ``max_labels`` different labels raise
an error, as a column with so many is hardly one of languages and each takes about 2 MB of the driver and of every task.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows with a null label are predicted but not
learned from. Without any labelled row every language is ``und``. Equal counts: the language that sorts first. Repeated
rows each get their row, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqgrid.llm.common import chunks, discard, written

PIECE = 1024
#: Characters that are parsed at once.
SLICE = 1 << 19
#: Labelled texts drawn for each language, about, or more where short texts don't fill the sample, and the characters that the
#: sample takes of one at most.
ROWS, WINDOW = 80, 20_000
LETTER = r"\p{L}"
#: Languages with more classes of characters, or whose table goes beyond these bytes in all, get a sorted list of transitions.
DENSE_CLASSES, DENSE_BYTES = 128, 128 << 20
FLAG = np.int32(1 << 30)


def training_rows(docs: DataFrame, *, id_col: str = "doc_id", folds: int = 5) -> Column:
    """The rows that may be learned from: crc32 of the id as text is not a multiple of ``folds``."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % folds) != 0


def sample(docs: DataFrame, where: Column, *, text_col: str, lang_col: str, sample_chars: int, max_labels: int = 256) -> dict[str, list[str]]:
    """A bounded sample for each language: texts whose hash falls below a threshold that lets about ``ROWS`` through, or as many
    as hold ``sample_chars`` and a half more.

    Only texts with a letter are counted and drawn, and copies count once. Of a text over ``WINDOW`` characters the sample
    takes a window at a hashed place, or at the first letter where that one holds none. The texts of a language reach the
    driver until they have ``sample_chars`` characters.
    """
    text, lang, hashed = F.col(text_col), F.col(lang_col).alias("lang"), F.xxhash64(F.col(text_col))
    labelled = docs.where(where & F.col(lang_col).isNotNull() & text.rlike(LETTER))
    mean = F.avg(F.least(F.length(text), F.lit(WINDOW)))
    want = F.greatest(F.lit(float(ROWS)), 1.5 * sample_chars / F.col("mean"))
    counts = labelled.groupBy(lang).agg(F.approx_count_distinct(hashed, 0.02).alias("n"), mean.alias("mean")).select("lang", (want / F.col("n")).alias("share"))
    counts = written(counts, "labels")  # a row a label
    if (labels := counts.count()) > max_labels:
        raise ValueError(f"{labels} labels are more than max_labels ({max_labels}); is {lang_col} a column of languages?")
    picked = labelled.select(lang, text.alias("text"), hashed.alias("h")).join(F.broadcast(counts), "lang")
    picked = picked.where(F.pmod(F.col("h"), F.lit(1_000_000_007)) / 1_000_000_007.0 < F.col("share"))
    start = 1 + F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))).cast("int")
    cut = F.col("text").substr(start, F.lit(WINDOW))
    cut = F.when(cut.rlike(LETTER), cut).otherwise(F.col("text").substr(F.regexp_instr("text", F.lit(LETTER)), F.lit(WINDOW)))
    once = picked.groupBy("lang", "h").agg(F.min(cut).alias("text"))
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1))
    out: dict[str, list[str]] = {}
    for r in once.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < sample_chars).orderBy("lang", "h").collect():
        out.setdefault(r["lang"], []).append(r["text"][: sample_chars - r["before"]])
    discard(counts)
    return out


class Alphabet:
    """Maps code points to classes: 0 space and all that is not a letter, then every letter seen in training, last any
    other letter. Upper and lower case share one."""

    def __init__(self, texts: list[str]):
        found = sorted({c for t in texts for c in set(t.lower()) if c.isalpha()})
        self.size = len(found) + 2
        self.table = np.zeros(0x110000, np.uint16 if self.size < 1 << 16 else np.int32)
        letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
        self.table[[ord(c) for c in letters]] = self.size - 1
        rank = {c: k + 1 for k, c in enumerate(found)}
        for c in letters:
            if (low := c.lower()) in rank:
                self.table[ord(c)] = rank[low]

    def codes(self, text: str) -> np.ndarray:
        """Classes of the text's characters, with runs of non-letters as one."""
        c = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if len(c) > 1:
            keep = np.ones(len(c), bool)
            keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
            c = c[keep]
        return c

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """The codes of the text in pieces of PIECE, made SLICE characters at a time."""
        rest, blank = np.zeros(0, self.table.dtype), False
        for at in range(0, len(text), SLICE):
            c = self.codes(text[at : at + SLICE])
            if blank and len(c) and c[0] == 0:  # a run of non-letters over the edge stays one
                c = c[1:]
            if not len(c):
                continue
            blank = c[-1] == 0
            c = np.concatenate((rest, c)) if len(rest) else c
            whole = len(c) // PIECE * PIECE
            for a in range(0, whole, PIECE):
                yield c[a : a + PIECE]
            rest = c[whole:]
        if len(rest):
            yield rest


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts all substrings; state 0 is the start."""
    nxt, link, length = [{}], [-1], [0]
    last = 0
    for c in codes.tolist():
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Table:
    """An automaton's transitions. Its classes are those that its own text has, and one for all others. Small ones are dense:
    at state x class, the next state times the number of classes, plus FLAG if a phrase ends before this character. Large
    ones are sorted by state x class, and what isn't there ends a phrase. Only the sorted form travels."""

    def __init__(self, codes: np.ndarray, classes: int):
        own = np.unique(codes)
        self.n = n = len(own) + 1
        self.own = np.full(classes, n - 1, np.int32)
        self.own[own] = np.arange(len(own), dtype=np.int32)
        edges = suffix_automaton(self.own[codes])
        self.states = len(edges)
        keys = np.array([s * n + c for s, e in enumerate(edges) for c in e], np.int64)
        to = np.array([v for e in edges for v in e.values()], np.int32)
        order = np.argsort(keys)
        self.keys, self.to = np.append(keys[order], self.states * n), np.append(to[order], np.int32(0))
        self.bytes = 4 * self.states * n

    def build(self, dense: bool) -> None:
        n, keys, to = self.n, self.keys[:-1], self.to[:-1]
        self.dense = dense
        first = int(np.searchsorted(keys, n))
        self.root = np.full(n, FLAG, np.int32)
        self.root[keys[:first]] = FLAG + to[:first] * (n if dense else 1)
        if dense:
            self.flat = np.tile(self.root, self.states)
            self.flat[:n] = FLAG
            self.flat[keys] = to * np.int32(n)

    def drop(self) -> None:
        self.flat = None

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        if self.dense:
            return self.flat[state + c]
        key = state.astype(np.int64) * self.n + c
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.to[at], self.root[c])


class Model:
    def __init__(self, texts: dict[str, tuple[str, ...]]):
        self.langs = sorted(texts)
        self.alphabet = Alphabet([t for v in texts.values() for t in v])
        learn, hold = {}, {}
        for k, v in texts.items():
            joined = " ".join(v)
            cut = max(1, len(joined) * 9 // 10)
            learn[k], hold[k] = joined[:cut], joined[cut:]
        most = max(map(len, learn.values()))  # equally much text where there is enough, so that none matches longer for having more
        least = min(len(v) for v in learn.values() if 2 * len(v) >= most)
        self.tables = [Table(self.alphabet.codes(learn[k][:least]), self.alphabet.size) for k in self.langs]
        self.open()
        self.own = np.ones(len(self.langs))
        self.own = np.array([max(np.nan_to_num(self.rates([hold[k]])[0][j], nan=1.0), 1e-6) for j, k in enumerate(self.langs)])
        # a language with little text compresses even its own badly; that must not excuse what it does to others'
        top = max(self.own[j] for j, k in enumerate(self.langs) if 2 * len(learn[k]) >= most)
        self.own = np.minimum(self.own, top)
        self.own /= self.own.mean() or 1.0

    def open(self) -> None:
        """Lay out the tables; the smallest ones densely."""
        total = 0
        for t in sorted(self.tables, key=lambda t: t.bytes):
            total += t.bytes
            t.build(t.n <= DENSE_CLASSES and total <= DENSE_BYTES)

    def close(self) -> None:
        """Drop what ``open`` has laid out."""
        for t in self.tables:
            t.drop()

    def rates(self, texts: list[str]) -> np.ndarray:
        """Normalised phrases a character, by text and language; not a number where no letter is."""
        phrases, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        letters = np.zeros(len(texts), bool)
        pieces, of, held = [], [], 0

        def parse() -> None:
            nonlocal held
            if pieces:
                np.add.at(phrases, np.array(of), self._parse(pieces))
            pieces.clear()
            of.clear()
            held = 0

        for k, text in enumerate(texts):
            for c in self.alphabet.pieces(text):
                pieces.append(c)
                of.append(k)
                sizes[k] += len(c)
                letters[k] |= c.any()
                held += len(c)
                if held >= SLICE:
                    parse()
        parse()
        sizes[~letters] = np.nan
        return phrases / sizes[:, None] / self.own[None, :]

    def _parse(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases by piece and language; the pieces advance in step, the longest first."""
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        size = np.array([len(pieces[k]) for k in order])
        grid = np.zeros((int(size[0]), len(pieces)), np.int32)
        for col, k in enumerate(order):
            grid[: size[col], col] = pieces[k]
        live = np.searchsorted(-size, -np.arange(len(grid)), side="left")
        out = np.zeros((len(pieces), len(self.langs)))
        for j, t in enumerate(self.tables):
            state = np.zeros(len(pieces), np.int32)
            ends = np.zeros(len(pieces), np.int32)
            own = t.own[grid]
            for i, n in enumerate(live.tolist()):
                v = t.step(state[:n], own[i, :n])
                ends[:n] += v >> 30
                np.bitwise_and(v, FLAG - 1, out=state[:n])
            out[order, j] = ends + 1
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        rates = self.rates([t or "" for t in texts])
        langs, scores = [], []
        for r in rates:
            if np.isnan(r[0]):
                langs.append("und")
                scores.append(0.0)
                continue
            k = int(np.argmin(r))
            w = np.exp(-(r - r[k]) / max(r[k], 1e-9) * 8)
            langs.append(self.langs[k])
            scores.append(float(1 / w.sum()))
        return langs, scores


def train(
    docs: DataFrame, where: Column | None = None, *, text_col: str = "text", lang_col: str = "lang", sample_chars: int = 60_000, max_labels: int = 256
) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The model as plain text: (language, texts) pairs for every label, at most ``sample_chars`` characters each."""
    got = sample(docs, F.lit(True) if where is None else where, text_col=text_col, lang_col=lang_col, sample_chars=sample_chars, max_labels=max_labels)
    return tuple((k, tuple(v)) for k, v in got.items())


def identify(docs: DataFrame, model: tuple[tuple[str, tuple[str, ...]], ...], *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1); input columns of these names give way. Only the text is looked at."""
    stay = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*stay).schema.add("lang_pred", "string").add("score", "double")

    built = Model(dict(model)) if model else None
    if built:
        built.close()
    shared = docs.sparkSession.sparkContext.broadcast(built)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        if m:
            m.open()
        try:
            for b in chunks(batches, text_col, 2 << 20):
                texts = b.column(text_col).to_pylist()
                langs, scores = m.predict(texts) if m else (["und"] * len(texts), [0.0] * len(texts))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])
        finally:
            if m:
                m.close()

    return docs.select(*stay).mapInArrow(run, schema)
