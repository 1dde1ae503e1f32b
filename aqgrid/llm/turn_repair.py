"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

A legal conversation is empty, or an optional system turn and then pairs of a user's and an assistant's turn. Rows are dealt
by conversation and sorted by turn once; a task streams them through Arrow batches and carries the state of a dynamic
program over the four places where a repaired conversation can stand (start, after the system turn, after a user, after an
assistant) from batch to batch. Each place has its least cost and its rank among the places' texts of edits, so that of
equally cheap repairs the one whose edits come first in ASCII wins. Every row adds one backpointer of four bytes; these and
the turns of the open conversation lie in spools that go to the task's temporary files once they are large, so that a giant
conversation takes a bounded memory. What stays in memory is the text of its edits, one letter a turn, which is a result.

Edits: K keeps a turn; R gives it the role that is due, user or assistant; D deletes it, which blank and repeated turns
require; I inserts an empty turn of the role that is due. A truncated turn that stays costs one more.

Nulls: a null role or text counts as one space (so the turn is blank, or its role fits nowhere); a null turn comes first; rows
without an id form one conversation of their own. Rows with equal turns are ordered by role, then text. A repeated row is a
duplicate. Empty texts are blank. An empty table gives no rows. Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import tempfile
from collections.abc import Iterable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What a turn's white space may consist of.
WHITE = "\x20\t\n\x0b\x0c\r"
#: Bytes of turns and of backpointers of the open conversation that stay in memory.
TURN_BYTES, BACK_BYTES = 8 << 20, 1 << 20
#: Rows of a result that are sent on at once.
SEND = 4096

START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that is due at a place, as the place it leads to; what an inserted or renamed turn becomes.
DUE = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
COST_RENAME, COST_DELETE, COST_INSERT, COST_TRUNCATED = 2, 3, 2, 1
#: Turns to insert before the next turn, and where they lead; more never pay.
INSERTS = tuple(tuple((k, place) for k, place in enumerate((p, DUE[p], DUE[DUE[p]]))) for p in range(4))
#: ``EXTRA[r][t]``: the most that a repair which stands at r pays more from here on than one at t. Places that cost more than
#: this above another lead to no cheapest repair; leaving them out keeps the costs within a few of each other.
EXTRA = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))
DELETE_ONLY = ("", False, True)


@cache
def _step(costs: tuple[int | None, ...], ranks: tuple[int, ...], turn: tuple[str, bool, bool]):
    """One turn: (new costs from 0 on, new ranks, what was taken off, four packed backpointers).

    ``turn``: the role's initial, whether it is truncated, whether it must go.
    """
    initial, cut, gone = turn
    best: list[tuple | None] = [None] * 4
    for p in range(4):
        if costs[p] is None:
            continue
        for k, q in INSERTS[p]:
            options = [("D", COST_DELETE, q)]
            if not gone:
                due = DUE[q]
                if initial == ("u" if due == USER else "a"):
                    options.append(("K", COST_TRUNCATED * cut, due))
                elif initial == "s" and q == START:
                    options.append(("K", COST_TRUNCATED * cut, SYSTEM))
                options.append(("R", COST_RENAME + COST_TRUNCATED * cut, due))
            for edit, cost, to in options:
                found = (costs[p] + k * COST_INSERT + cost, ranks[p], "I" * k + edit, p)
                if best[to] is None or found < best[to]:
                    best[to] = found
    best = [b if b and all(o is None or b[0] <= o[0] + EXTRA[r][t] for r, o in enumerate(best)) else None for t, b in enumerate(best)]
    least = min(b[0] for b in best if b)
    order = sorted((b[1:3], t) for t, b in enumerate(best) if b)
    rank = {t: i for i, (_, t) in enumerate(order)}
    back = bytes(b[3] | (len(b[2]) - 1) << 2 | "DKR".index(b[2][-1]) << 4 if b else 255 for b in best)
    return tuple(b[0] - least if b else None for b in best), tuple(rank.get(t, 0) for t in range(4)), least, back


class Repair:
    """The open conversation: counts, the state of the program, and spools of backpointers and turns."""

    def __init__(self, key: str | None):
        self.key, self.n, self.cost = key, 0, 0
        self.costs, self.ranks = (0, None, None, None), (0, 0, 0, 0)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.distinct, self.before = 0, None
        self.back = tempfile.SpooledTemporaryFile(max_size=BACK_BYTES)
        self.turns = tempfile.SpooledTemporaryFile(max_size=TURN_BYTES)

    def add(self, turn: int | None, role: str, text: str, blank: bool, seen: bool, cut: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.n += 1
        gone = blank or seen
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut and not gone
        self.costs, self.ranks, more, back = _step(self.costs, self.ranks, DELETE_ONLY if gone else (initial, cut, False))
        self.cost += more
        self.back.write(back)
        if not gone:
            record = pickle.dumps((turn, role, text), pickle.HIGHEST_PROTOCOL)
            self.turns.write(struct.pack("<qq", self.n - 1, len(record)) + record)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct

    def edits(self) -> bytes:
        """The letters of the cheapest edits; sets ``cost``. To be called once, after the last turn."""
        ends = []
        for p, cost in enumerate(self.costs):
            k = next((k for k, q in INSERTS[p] if q in (ASSISTANT, START)), None)  # a place to end, by the fewest inserts
            if cost is not None and k is not None:
                ends.append((cost + k * COST_INSERT, self.ranks[p], k, p))
        cost, _, k, place = min(ends)
        self.cost += cost
        out, at = bytearray(b"I" * k), self.n
        while at:
            of = max(0, at - (1 << 16))
            self.back.seek(4 * of)
            block = self.back.read(4 * (at - of))
            for i in range(at - of - 1, -1, -1):
                b = block[4 * i + place]
                out.append(b"DKR"[b >> 4])
                out += b"I" * (b >> 2 & 3)
                place = b & 3
            at = of
        out.reverse()
        return bytes(out)

    def repaired(self, edits: bytes) -> Iterator[tuple[str, int | None, str, str]]:
        """The turns that the edits leave: letter, turn (null if inserted), role, text."""
        self.turns.seek(0)
        place, row, ahead = START, -1, None
        for e in edits:
            if e == 73:  # I
                place = DUE[place]
                yield "I", None, NAMES[place], ""
                continue
            row += 1
            if e == 68:  # D
                continue
            while ahead is None or ahead < row:
                ahead, size = struct.unpack("<qq", self.turns.read(16))
                turn, role, text = pickle.loads(self.turns.read(size))
            if e == 75 and place == START and role[:1] == "s":
                place = SYSTEM
            else:
                place = DUE[place]
                role = role if e == 75 else NAMES[place]
            yield chr(e), turn, role, text

    def close(self) -> None:
        self.back.close()
        self.turns.close()


def _conversations(batches: Iterable[pd.DataFrame]) -> Iterator[Repair]:
    """Each conversation of the sorted rows, complete; it is closed when the next one is asked for."""
    now: Repair | None = None
    try:
        for batch in batches:
            columns = [batch[c].tolist() for c in ("id", "here", "has_turn", "turn", "role", "text", "blank", "seen", "cut")]
            for key, here, has_turn, turn, role, text, blank, seen, cut in zip(*columns, strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        yield now
                        now.close()
                    now = Repair(key)
                if here:
                    now.add(turn if has_turn else None, role, text, blank, seen, cut)
        if now is not None:
            yield now
    finally:
        if now is not None:
            now.close()


def _sorted(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: str | None) -> DataFrame:
    """Rows by conversation, in order, with their faults: one shuffle of the rows, then two sorts within its partitions."""
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    d = turns.select(
        F.col(id_col).cast("string").alias("id"),
        here.alias("here"),
        F.col(turn_col).isNotNull().alias("has_turn"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"),
    ).repartition("id")
    same = Window.partitionBy("id", "here", F.xxhash64("role", "text"), "role", "text").orderBy("has_turn", "turn")
    body = F.rtrim("text", F.lit(WHITE))
    d = d.withColumn("seen", F.row_number().over(same) > 1).withColumns({"blank": body == "", "cut": ~F.substring(body, -1, 1).isin(".", "!", "?")})
    return d.sortWithinPartitions("id", "here", "has_turn", "turn", "role", "text", "seen")


def repair(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: id, position, edit (K, R or I), turn (null if inserted), role, text.

    ``present`` may name a boolean column; rows where it isn't true only tell that their conversation exists.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=["id", "position", "edit", "turn", "role", "text"]).astype({"turn": "Int64"})
        rows, held = [], 0
        for c in _conversations(batches):
            for i, (edit, turn, role, text) in enumerate(c.repaired(c.edits())):
                rows.append((c.key, i, edit, turn, role, text))
                held += len(text)
                if len(rows) >= SEND or held >= TURN_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
        if rows:
            yield frame(rows)

    out = _sorted(turns, id_col, turn_col, role_col, text_col, present).mapInPandas(run, "id string, position long, edit string, turn long, role string, text string")
    return out.withColumn("id", F.col("id").cast(turns.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def report(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: str | None = None) -> DataFrame:
    """One row a conversation: the faults of its turns, the cost and the letters of its edits, and the SHA-256 of what they
    leave (``role:text``, joined by newlines). A turn counts for its first fault: blank, duplicate or truncated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        rows, held = [], 0
        for c in _conversations(batches):
            edits, sha, between = c.edits(), hashlib.sha256(), b""
            for _, _, role, text in c.repaired(edits):
                sha.update(between + f"{role}:{text}".encode())
                between = b"\n"
            rows.append((c.key, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, edits.decode(), sha.hexdigest()))
            held += len(edits)
            if len(rows) >= SEND or held >= TURN_BYTES:
                yield pd.DataFrame(rows, columns=names)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    schema = "id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    out = _sorted(turns, id_col, turn_col, role_col, text_col, present).mapInPandas(run, schema)
    return out.withColumn("id", F.col("id").cast(turns.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def damage(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations``, damaged by the CRC-32 of ``conv_id:turn`` modulo 20; a null counts as one space there.

    0 drops a row, which stays with ``here`` false so that its conversation is known; 1 empties its text, 2 removes the ends of
    its sentences, 3 repeats it, 4 makes it a user's.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("how"))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    d = d.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("how") != 0).alias("here"), "how")
    twice = F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return d.withColumn("copy", twice).drop("how", "copy")
