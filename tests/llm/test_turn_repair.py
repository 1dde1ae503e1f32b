import hashlib
import itertools
import random
import zlib

import pytest

from aqgrid.llm import turn_repair
from aqgrid.llm.queries import op11_turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def all_repairs(turns):
    """(cost, audit, lines) of every sequence of edits with at most two inserts at a place."""
    seen, facts = set(), []
    for role, text in turns:
        body = text.rstrip(BLANKS)
        facts.append((role, text, not body or (role, text) in seen, body[-1:] not in tuple(".!?")))
        seen.add((role, text))
    due = {"0": "user", "s": "user", "a": "user", "u": "assistant"}
    out = []

    def go(i, place, cost, audit, lines):
        for k in range(3):
            if i == len(facts):
                if place in "0a":
                    out.append((cost, audit, lines))
            else:
                role, text, gone, cut = facts[i]
                go(i + 1, place, cost + 3, audit + "D", lines)
                if not gone:
                    if role[:1] == due[place][0]:
                        go(i + 1, role[0], cost + cut, audit + "K", [*lines, f"{role}:{text}"])
                    if role[:1] == "s" and place == "0":
                        go(i + 1, "s", cost + cut, audit + "K", [*lines, f"{role}:{text}"])
                    go(i + 1, due[place][0], cost + 2 + cut, audit + "R", [*lines, f"{due[place]}:{text}"])
            cost, audit, lines, place = cost + 2, audit + "I", [*lines, f"{due[place]}:"], due[place][0]

    go(0, "0", 0, "", [])
    return min(out)


def least_repair(turns):
    """As ``all_repairs``, by keeping the least repair of each place with its whole text of edits."""
    seen, best = set(), {"0": (0, "", [])}
    due = {"0": "user", "s": "user", "a": "user", "u": "assistant"}

    def wider(best):
        out = dict(best)
        for place, (cost, audit, lines) in best.items():
            for _ in range(2):
                cost, audit, lines, place = cost + 2, audit + "I", [*lines, f"{due[place]}:"], due[place][0]
                out[place] = min(out.get(place, (cost + 1,)), (cost, audit, lines))
        return out

    for role, text in turns:
        body = text.rstrip(BLANKS)
        gone, cut = not body or (role, text) in seen, body[-1:] not in tuple(".!?")
        seen.add((role, text))
        found = []
        for place, (cost, audit, lines) in wider(best).items():
            found.append((place, (cost + 3, audit + "D", lines)))
            if not gone:
                if role[:1] == due[place][0] or role[:1] == "s" and place == "0":
                    found.append((role[0], (cost + cut, audit + "K", [*lines, f"{role}:{text}"])))
                found.append((due[place][0], (cost + 2 + cut, audit + "R", [*lines, f"{due[place]}:{text}"])))
        best = {p: min(v for q, v in found if q == p) for p in {q for q, _ in found}}
    return min(v for p, v in wider(best).items() if p in "0a")


def plain_report(rows, repairs=least_repair):
    """Every conversation's report, from rows (conv_id, turn, role, text)."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted([(t is not None, t or 0, r or " " if r is None else r, " " if x is None else x) for cc, t, r, x in rows if cc == c])
        seen, blank, duplicate, truncated = set(), 0, 0, 0
        for _, _, role, text in mine:
            body = text.rstrip(BLANKS)
            blank += not body
            duplicate += bool(body) and (role, text) in seen
            truncated += bool(body) and (role, text) not in seen and body[-1] not in ".!?"
            seen.add((role, text))
        turns = {t for known, t, _, _ in mine if known}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, lines = repairs([(r, x) for _, _, r, x in mine])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[c] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def collected(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_report_matches_every_repair(spark, seed):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["system", "user", "assistant", "assistant", "user", "tool"]), r.choice(["a.", "b", "c?", " ", "d! \n", "e", "f."])) for c in range(60) for t in range(r.randrange(1, 5))]
    assert collected(turn_repair.report(spark.createDataFrame(rows, SCHEMA))) == plain_report(rows, all_repairs)


@pytest.mark.parametrize("seed", [3, 4])
def test_report_of_longer_conversations(spark, seed):
    r = random.Random(seed)
    rows = [(c, t + t // 7, r.choice(["system", "user", "assistant", "assistant", "user", "x"]), r.choice(["a.", "b", "c?", " ", "d!"]) + str(r.randrange(9)) + r.choice(["", "."])) for c in range(25) for t in range(r.randrange(1, 70))]
    assert collected(turn_repair.report(spark.createDataFrame(rows, SCHEMA))) == plain_report(rows)


def test_report_of_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "a."), (1, None, "assistant", "b."), (1, None, "user", "a."), (1, 0, "user", "a."), (2, 5, "user", "x."), (2, 5, "user", "x."), (2, 5, "user", "x."),
        (3, 1, "", "q."), (3, 2, "assistant", "r."), (4, 1, "system", "only."), (5, 1, "user", ""), (5, 9, "user", "\t\r"), (6, -4, "u", "kept?"), (6, 4, "a", "kept! " + "y" * 300_000 + ".\x0b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(turn_repair.report(df))
    assert got == plain_report(rows)
    assert got[5] == (8 - 1, 2, 0, 0, 1, 6, "DD", hashlib.sha256(b"").hexdigest())
    clash = df.withColumns({c: df.text for c in ("id", "here", "seen", "cut", "audit", "position", "has_turn")})
    assert collected(turn_repair.report(clash)) == got
    assert turn_repair.report(df.where("false")).collect() == []


def test_repair_returns_the_turns(spark):
    rows = [(7, 1, "system", "s."), (7, 2, "assistant", "a."), (7, 3, "user", "a."), (7, 4, "user", "b"), (8, 1, "user", " "), (9, 1, "user", "q."), (9, 2, "user", "q."), (9, 3, "assistant", "z.")]
    got = turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in got if r.conv_id == 9] == [(9, 0, "K", 1, "user", "q."), (9, 1, "K", 3, "assistant", "z.")]
    report = collected(turn_repair.report(spark.createDataFrame(rows, SCHEMA)))
    for c in (7, 8, 9):
        lines = [f"{r.role}:{r.text}" for r in got if r.conv_id == c]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == report[c][-1]
        assert "".join(r.edit for r in got if r.conv_id == c) == report[c][-2].replace("D", "")


def test_giant_conversation_spills(spark, monkeypatch):
    """Several Arrow batches, spools far smaller than the conversation."""
    monkeypatch.setattr(turn_repair, "TURN_BYTES", 1000)
    monkeypatch.setattr(turn_repair, "BACK_BYTES", 64)
    c, r = turn_repair.Repair("x"), random.Random(5)
    turns = [(r.choice(["user", "assistant", "system", "z"]), f"{i}{r.choice(['.', ''])}") for i in range(70_000)]
    for i, (role, text) in enumerate(turns):
        c.add(i, role, text, False, False, text[-1] != ".")
    edits = c.edits()
    cost, audit, lines = 0, [], []
    cost = sum({68: 3, 82: 2, 73: 2, 75: 0}[e] for e in edits)
    kept = [f"{role}:{text}" for _, _, role, text in c.repaired(edits)]
    cut = sum(not k.endswith((".", ":")) for k in kept)
    assert cost + cut == c.cost
    initials = "".join(k[0] for k in kept)
    assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
    c.close()
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns[:25_000])]
    got = collected(turn_repair.report(spark.createDataFrame(rows, SCHEMA).repartition(5)))[1]
    c = turn_repair.Repair("y")
    for i, (role, text) in enumerate(turns[:25_000]):
        c.add(i, role, text, False, False, text[-1] != ".")
    assert got[6] == c.edits().decode() and got[5] == c.cost
    c.close()


def test_query_against_plain(spark, sf):
    rows = []
    every = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    for c, t, role, text in every:
        role, text = role or " ", text or " "
        how = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if how == 1 else "".join(x for x in text if x not in ".!?") if how == 2 else text
        rows += [(c, t, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    want = plain_report(rows)
    for c in {r[0] for r in every} - set(want):
        want[c] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert collected(op11_turn_repair(spark, sf)) == want


def test_dropped_conversations_and_nulls(spark, tmp_path):
    gone = next(i for i in itertools.count() if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows = [(gone, 1, "user", "x."), (None, None, None, None), (None, None, "assistant", "q.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = collected(op11_turn_repair(spark, str(tmp_path)))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got) == {gone, None}
