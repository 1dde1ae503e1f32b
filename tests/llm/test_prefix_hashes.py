import hashlib
import os
import random

import pytest

from aqgrid.llm import prefix_hashes as ph
from aqgrid.llm.queries import op12_fingerprints


def windows(text):
    return {text[i : i + ph.WINDOW] for i in range(len(text) - ph.WINDOW + 1)} or ({text} if text else set())


def dice(a, b):
    x, y = windows(a), windows(b)
    return 1.0 if a == b else 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def plain(rows):
    """doc_id, n_chars, edited text and next text of rows (doc_id, text), by one sort."""
    order = sorted([(d is not None, d or 0, t or "") for d, t in rows], reverse=True)
    out = []
    for i, (known, d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][2]
        cut = len(t) // 3
        out.append((d if known else None, t, t[: len(t) - cut] + after[:cut], after))
    return out


def check(got, rows, near=0.22):
    want = plain(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted([(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in want], key=key)
    by = {(d, hashlib.sha256(e.encode()).hexdigest()): (t, e, a) for d, t, e, a in want}
    for r in got:
        t, e, a = by[r.doc_id, r.edited_sha256]
        assert r.fingerprint == str(ph.fingerprint(t)) and r.edited_fingerprint == str(ph.fingerprint(e))
        assert r.kept_prefix == len(os.path.commonprefix([t, e]))
        few = lambda *x: all(len(windows(y)) < ph.KEEP for y in x)
        assert abs(r.near_edited - dice(t, e)) <= (1e-12 if few(t, e) else near)
        assert abs(r.near_next - dice(t, a)) <= (1e-12 if few(t, a) else near)


def test_spans_and_extensions():
    r = random.Random(1)
    for _ in range(60):
        a = "".join(r.choice("ab") for _ in range(r.randrange(1, 40)))
        b = a[r.randrange(len(a)) :] + "".join(r.choice("abé😀") for _ in range(r.randrange(9)))
        x, y = ph.PrefixHashes(ph.code_points(a)), ph.PrefixHashes(ph.code_points(b))
        for _ in range(30):
            i, j, n = r.randrange(len(a) + 1), r.randrange(len(b) + 1), r.randrange(12)
            assert ph.spans_equal(a, i, b, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n])
            assert ph.extension(a, i, b, j) == len(os.path.commonprefix([a[i:], b[j:]]))
            if i + n <= len(a) and j + n <= len(b):
                assert (x.span(i, n) == y.span(j, n)) == (a[i : i + n] == b[j : j + n])
        w = x.windows(5).tolist()
        assert [s[0] << 31 | s[1] for s in (x.span(i, 5) for i in range(len(w)))] == w


def test_blocks_change_nothing(monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choice("abcdé ") for _ in range(n)) for n in (0, 1, 23, 24, 25, 500, 2000)]
    whole = [ph.fingerprint(t) for t in texts]
    monkeypatch.setattr(ph, "BLOCK", 37)
    assert [ph.fingerprint(t) for t in texts] == whole
    assert ph.extension(texts[-1] + "x", 0, texts[-1] + "y", 0) == 2000 == ph.extension(texts[-1], 0, texts[-1], 0)
    assert ph.spans_equal(texts[-1], 3, "zz" + texts[-1], 5, 1900)
    assert all(ph.Fingerprint.parse(str(f)) == f for f in whole)


def test_fingerprints_tell_texts_apart():
    assert str(ph.fingerprint("a")) != str(ph.fingerprint("aa")) != str(ph.fingerprint("\x00a"))
    assert ph.likeness(ph.fingerprint(""), ph.fingerprint("")) == 1.0
    assert ph.likeness(ph.fingerprint(""), ph.fingerprint("a")) == 0.0
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    for share in (0.1, 0.5, 0.9):
        errors = []
        for _ in range(20):
            a = text(5000)
            b = a[: int(5000 * share)] + text(5000 - int(5000 * share))
            errors.append(ph.likeness(ph.fingerprint(a), ph.fingerprint(b)) - dice(a, b))
        assert abs(sum(errors) / 20) < 0.06


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_neighbours_match_plain(make, ranges):
    r = random.Random(ranges)
    ids = r.sample(range(-50, 1000), 60)
    texts = [" ".join(r.choice(["alpha", "béta", "γάμμα", "x"]) for _ in range(r.randrange(60))) for _ in ids]
    texts[3] = texts[4] = texts[5]
    rows = list(zip(ids, texts, strict=True))
    check(ph.neighbours(make(texts, ids).repartition(4), ranges=ranges).collect(), rows)


def test_neighbours_of_odd_rows(make, spark):
    rows = [(None, None), (None, "nobody's text"), (5, ""), (5, "five"), (5, "five"), (9, "x" * 300_000 + "y"), (10, "x" * 300_000), (7, "ab"), (-3, None), (1, "😀😀😀")]
    df = make([t for _, t in rows], [d for d, _ in rows], part="x", ahead="x", n_chars="x")
    check(ph.neighbours(df, ranges=3).collect(), rows)
    assert ph.neighbours(df.where("false")).collect() == []
    check(ph.neighbours(df.where("doc_id IS NULL"), ranges=3).collect(), rows[:2])
    one = ph.neighbours(make(["abcdef"], [4])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_extensions_of_pairs(spark):
    df = spark.createDataFrame([("abcd", 1, "xbcy", 1, "k"), (None, 0, "a", 0, "k"), ("a", 5, "a", 0, "k")], "a string, i int, b string, j int, extension string")
    got = ph.extensions(df, "a", "i", "b", "j")
    assert got.columns == ["a", "i", "b", "j", "extension"]
    assert [r.extension for r in got.collect()] == [2, None, 0]


def test_query_against_plain(spark, sf, rows, documents):
    check(op12_fingerprints(spark, sf).collect(), list(rows.items()), near=0.25)
    alone = {r.doc_id: r.fingerprint for r in ph.fingerprints(documents).collect()}
    assert alone == {d: str(ph.fingerprint(t or "")) for d, t in rows.items()}
