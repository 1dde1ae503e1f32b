import hashlib
import itertools
import random

import pytest

from aqgrid.llm import decontamination, graph, ngram_join, substring_dedup


def plain_dedup(rows, k):
    words = {d: (t or "").encode().split() for d, t in rows.items()}
    least = {}
    for d in sorted(words):
        for i in range(len(words[d]) - k + 1):
            least.setdefault(tuple(words[d][i : i + k]), d)
    out = {}
    for d, ws in words.items():
        gone = {p for i in range(len(ws) - k + 1) if least[tuple(ws[i : i + k])] < d for p in range(i, i + k)}
        kept = [w for p, w in enumerate(ws) if p not in gone]
        out[d] = (len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def random_docs(seed, n=60, vocabulary=6, longest=80):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(vocabulary)]
    docs = [" ".join(r.choice(word) for _ in range(r.randrange(longest))) for _ in range(n)]
    for _ in range(n // 3):  # copies, near copies and shared passages
        a, b = r.randrange(n), r.randrange(n)
        x = docs[a].split()
        if x:
            x[r.randrange(len(x))] = "zz"
        docs[b] = r.choice([docs[a], " ".join(x), docs[b] + "\n" + docs[a]])
    return dict(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_matches_plain(make, seed):
    rows = random_docs(seed) | {100: None, 101: "", 102: "w1", 103: "\x0bw1 \t w2\n" * 30, 104: "w1 w2 " * 30}
    got = substring_dedup.digest(make(list(rows.values()), list(rows)), k=5, m=2).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain_dedup(rows, 5)


def test_substring_dedup_over_real_texts(documents, rows):
    got = substring_dedup.digest(documents).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain_dedup(rows, 13)


def test_substring_dedup_over_many_chunks(spark):
    r = random.Random(9)
    word = lambda: f"v{r.randrange(10**6)}"
    passage = " ".join(word() for _ in range(40))
    rows = {d: " ".join([*(word() for _ in range(80)), passage, *(word() for _ in range(60 + d % 7))]) for d in range(6_000)}  # several chunks a task
    order = sorted(rows, key=lambda d: -d)  # the smallest id comes last
    docs = spark.createDataFrame([(d, rows[d]) for d in order], "doc_id long, text string").coalesce(1)
    got = substring_dedup.digest(docs).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in got} == plain_dedup(rows, 13)


def test_substring_dedup_of_odd_rows(make):
    t = " ".join(f"a{i}" for i in range(20))
    got = substring_dedup.deduplicate(make([t, t, t, t], [1, 1, 2, None], start="x", stop="y", bucket="z")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 20)]
    assert substring_dedup.digest(make([])).count() == 0


def test_hash_clashes_are_resolved_by_words(monkeypatch):
    import numpy as np

    from aqgrid.llm.common import Words

    monkeypatch.setattr(Words, "grams", lambda self, k: np.zeros(max(0, self.n - k + 1), np.uint64))
    doc, first = np.array([1, 2, 3]), np.array([0, 0, 0])
    out = substring_dedup.duplicate_runs(doc, first, [b"a b c", b"x y z", b"a b c"], 3)
    assert out == [(3, 0, 3)]


def plain_classes(rows, percent=75):
    sets = {}
    for d, t in rows.items():
        ws = (t or "").encode().lower().split()
        sets[d] = {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()
    up = {d: d for d in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in rows}


def near_copies(seed, n=70):
    r = random.Random(seed)
    base = [[f"b{k}w{r.randrange(400)}" for _ in range(r.randrange(1, 120))] for k in range(6)]
    out = {}
    for d in range(n):
        ws = list(r.choice(base))
        for _ in range(r.randrange(0, 5)):
            p = r.randrange(len(ws))
            ws[p : p + r.randrange(2)] = [f"e{r.randrange(50)}"] * r.randrange(2)
            ws = ws or ["x"]
        if r.random() < 0.2:
            ws += r.choice(base)
        out[d] = " ".join(w.upper() if r.random() < 0.1 else w for w in ws)
    return out | {900: None, 901: "", 902: "A b", 903: "a B", 904: "a b c"}


@pytest.mark.parametrize(("seed", "limit"), [(1, 10**6), (2, 10**6), (3, 300), (4, 300), (5, 800)])
def test_ngram_join_matches_plain(make, seed, limit):
    rows = near_copies(seed)
    got = ngram_join.ngram_join(make(list(rows.values()), list(rows)), group_shingles=limit).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows)


@pytest.mark.parametrize("short", [1, 2, 5])
def test_long_lists_give_the_same(make, short):
    rows = near_copies(11)
    got = ngram_join.ngram_join(make(list(rows.values()), list(rows)), short_list=short).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows)


def texts_with_phrases(seed, n=240, phrases=12):
    """Texts of their own words and of several common phrases each; every tenth has two near copies."""
    r = random.Random(seed)
    phrase = [[f"p{k}x{j}" for j in range(9)] for k in range(phrases)]
    out, planted = {}, []
    for d in range(0, n, 3):
        ws = []
        for x in r.sample(phrase, 6):
            ws += x + [f"u{d}y{r.randrange(10**6)}" for _ in range(3)]
        planted.append({d} if d % 30 else {d, d + 1, d + 2})
        for c in sorted(planted[-1]):
            out[c] = " ".join([*ws, f"tail{c}"])
    return out, planted


def test_common_phrases_don_t_make_groups(make):
    rows, planted = texts_with_phrases(3)
    docs = make(list(rows.values()), list(rows))
    one = docs.selectExpr("1L AS grp", "doc_id AS id", "text")
    found = {}
    for x in ngram_join.regrouped(one, k=5, percent=75, short_list=8).collect():
        found.setdefault(x.grp, set()).add(x.id)
    whole = {frozenset(c) for c in planted if len(c) > 1}
    assert {frozenset(x) for x in found.values()} == whole
    got = ngram_join.ngram_join(docs, group_shingles=200, short_list=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows)


@pytest.mark.parametrize(("short", "seed"), [(1, 21), (3, 22), (32, 23)])
def test_regrouping_loses_no_link(make, short, seed):
    rows = near_copies(seed)
    docs = make(list(rows.values()), list(rows)).where("text IS NOT NULL")
    found = {}
    for x in ngram_join.regrouped(docs.selectExpr("doc_id % 2 AS grp", "doc_id AS id", "text"), k=5, percent=75, short_list=short).collect():
        found.setdefault(x.id, set()).add(x.grp)
    for half in (0, 1):
        classes = plain_classes({d: t for d, t in rows.items() if d % 2 == half})
        for d, (n, c) in classes.items():
            if c != d and rows[c].lower() != rows[d].lower():
                assert found[d] & found[c]


def test_regrouping_with_repeated_ids(make):
    base = [f"w{i}" for i in range(60)]
    texts = {d: " ".join([*base, f"e{d}"]) for d in range(30)}
    other = {d: " ".join([f"o{d}z{i}" for i in range(40)]) for d in range(30)}
    got = ngram_join.ngram_join(make([*texts.values(), *other.values()], [*texts, *other]), group_shingles=100, short_list=2).collect()
    assert len(got) == 60
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(d, n, 0) for d in range(30) for n in (57, 36)}


def test_ngram_join_over_real_texts(documents, rows):
    got = ngram_join.ngram_join(documents).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows)


def test_ngram_join_of_odd_rows(make):
    t = "one two three four five six"
    got = ngram_join.ngram_join(make([t, t, t, None], [5, 5, None, 7], n="x", grp="y")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 2, 0), (5, 2, 5), (5, 2, 5), (7, 0, 7)]
    assert ngram_join.ngram_join(make([])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_search_with_any_split_finds_the_same(monkeypatch, seed):
    rows = {d: t for d, t in near_copies(seed).items() if t}
    texts = [t.encode() for t in rows.values()]
    for probed, entries in itertools.product((0, 1, 5, 10**6), (0, 10**9)):  # merged by sorts alone, and by heaps alone
        monkeypatch.setattr(ngram_join, "HEAP_ENTRIES", entries)
        monkeypatch.setattr(ngram_join, "divide_skip", lambda n, longest, need, p=probed: max(0, min(need - 1, p)))
        s = ngram_join.Search(texts, 5, 75)
        got = {(q, c) for q in range(len(texts)) for c in s.partners(q, lambda c: True)}
        sets = [set(s.terms(d).tolist()) for d in range(len(texts))]
        want = {(a, b) for a in range(len(texts)) for b in range(len(texts)) if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
        assert got == want


def near_misses(n=150):
    """Copies of one text, of which every third keeps so many of its words that it links with the others, the rest too few."""
    r = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    out = []
    for d in range(n):
        ws = list(base)
        for p in r.sample(range(0, 200, 5), 8 if d % 3 else 1):
            ws[p] = f"e{d}x{p}"
        out.append(" ".join(ws).encode())
    return out


@pytest.mark.parametrize("dense", [0, 1, 32, 10**9])
def test_near_misses_are_dropped_before_any_is_asked_for(monkeypatch, dense):
    monkeypatch.setattr(ngram_join, "DENSE", dense, raising=False)
    texts = near_misses()
    s, asked, got = ngram_join.Search(texts, 5, 75), [], set()
    for q in range(len(texts)):
        got |= {(q, c) for c in s.partners(q, lambda c, q=q: asked.append((q, c)) or True)}
    sets = [set(s.terms(d).tolist()) for d in range(len(texts))]
    links = {(a, b) for a in range(len(texts)) for b in range(len(texts)) if a != b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert 0 < len(links) < len(texts) ** 2 / 4
    assert got == links
    assert sorted(asked) == sorted(links)  # no pair costs a step of its own but those that link


@pytest.mark.parametrize("seed", range(6))
def test_asking_outside_the_largest_class_finds_all_classes(seed):
    rows = {d: t for d, t in near_copies(seed, 90).items() if t}
    texts, ids = [t.encode() for t in rows.values()], list(rows)
    forest = {d: d for d in ids}

    def root(x):
        while forest[x] != x:
            x = forest[x]
        return x

    for a, b in ngram_join.search_group(ids, texts, 5, 75):
        x, y = sorted((root(a), root(b)))
        assert x != y  # each link joins two classes
        forest[y] = x
    assert {d: root(d) for d in ids} == {d: c for d, (_, c) in plain_classes(rows).items()}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == up
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_align(item, region):
    prev = best = None
    for c in ["", *region]:
        cur = [0] + [prev[i] + 1 if prev else i for i in range(1, len(item) + 1)]
        if prev:
            for i in range(1, len(item) + 1):
                cur[i] = min(prev[i] + 1, cur[i - 1] + 1, prev[i - 1] + (item[i - 1] != c))
        prev, best = cur, cur[-1] if best is None else min(best, cur[-1])
    return best


def test_alignment_matches_plain():
    r = random.Random(1)
    for _ in range(800):
        item = "".join(r.choice("ab c") for _ in range(r.randint(1, 14)))
        region = "".join(r.choice("ab c") for _ in range(r.randint(0, 25)))
        k, want = r.randint(0, 5), plain_align(item, region)
        got = decontamination.align(item, region, k)
        assert (got is None) == (want > k)
        if got:
            assert got[0] == want == plain_align(item, region[got[1] : got[2]])


def edited(r, t, n):
    t = list(t)
    for _ in range(n):
        p = r.randrange(len(t))
        t[p : p + r.randrange(2)] = r.choice(["", "x", "q"])
    return "".join(t)


def test_leaks_within_the_budget_are_all_found(spark, make):
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghi") for _ in range(r.randint(2, 8))) for _ in range(n))
    items = [text(r.randint(8, 40)) for _ in range(25)] + ["short", "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs, planted = [], []
    for d in range(60):
        i = r.randrange(25)
        m = len(decontamination.normal(items[i]))
        k = decontamination.budget(m, 12, 0.05)
        n = r.choice([0, k, k, None])
        body = text(60)
        if n is not None:
            body = text(30) + " " + edited(r, items[i], n) + " " + text(30)
        docs.append(body.upper() if d % 2 else body)
    docs += [None, "", "a SHORT text"]
    got = {(x.doc_id, x.item_id): x for x in decontamination.leaks(make(docs, start="s"), bench).collect()}
    want = {}
    for d, t in enumerate(docs):
        t = decontamination.normal(t)
        for i, item in enumerate(items):
            item = decontamination.normal(item)
            if item:
                k = decontamination.budget(len(item), 12, 0.05)
                if (e := plain_align(item, t)) <= k:
                    want[d, i] = e
    assert {k: x.edits for k, x in got.items()} == want
    assert len(want) > 20
    kept = {x.doc_id for x in decontamination.clean(make(docs), bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in want}


def test_leaks_of_repeated_rows_and_nulls(spark, make):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over it"), (2, None), (None, "the quick brown fox jumps over it"), (1, "the quick brown fox jumps over it")], "item_id long, text string")
    t = "so THE quick\n brown fox  jumps over it, he said"
    got = decontamination.leaks(make([t, t, None, "", t], [4, 4, 5, 6, None], item_id="x", edits="y"), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in got) == sorted([(d, i) for d in (4, 4, 0) for i in (1, 1, 0)])
    assert {(r.start, r.end, r.edits) for r in got} == {(3, 36, 0)}


def test_steps_of_the_search_don_t_matter(monkeypatch):
    r = random.Random(12)
    item = lambda: " ".join("".join(r.choice("abcde") for _ in range(r.randint(2, 6))) for _ in range(r.randint(8, 30)))
    items = [(k, item()) for k in range(20)]

    def spoil(t):
        x = list(t)
        for _ in range(r.randrange(4)):
            x[r.randrange(len(x))] = "z"
        return "".join(x)

    texts = [" ".join(spoil(r.choice(items)[1]) if r.random() < 0.5 else item() for _ in range(r.randrange(60))) for _ in range(12)]
    index = decontamination.Index(items, 12, 0.05)
    want = sorted(decontamination.Scanner(index).scan(texts))
    assert len(want) > 50
    for step in (1, 7, 64, 1000):
        monkeypatch.setattr(decontamination, "STEP_CHARS", step)
        assert sorted(decontamination.Scanner(index).scan(texts)) == want
    monkeypatch.setattr(decontamination, "CHUNK", 5)
    for t in (*texts, "  A\u2003b \n", "ΑΣ ΣΑΣ x", " ", "x" * 50):
        assert decontamination.normal(t) == " ".join(t.lower().split())


def test_a_very_long_text_is_searched_in_bounded_memory(tmp_path):
    import os
    import subprocess
    import sys

    code = """
import resource
from aqgrid.llm import decontamination as d
item = " ".join(f"benchmark{k}" for k in range(40))
text = "some other words in between " * ((32 << 20) // 28) + item
text += " " + item + " tail" * 100
found = d.Scanner(d.Index([(1, item)], 12, 0.05)).scan([d.normal(text)])
assert len(found) == 2, found
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": root})
    assert int(out.stdout) < 500  # MB, of which the text is some 100


def test_leaks_of_empty_tables(spark, make):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(make(["some text"]), empty).count() == 0
    assert decontamination.clean(make(["some text"]), empty).count() == 1
    assert decontamination.clean(make([]), empty).count() == 0


def test_gram_hashes_are_of_the_grams():
    import numpy as np

    t = "abcabcabdabc"
    codes = decontamination._codes(t)
    for q in range(1, 13):
        h = decontamination.gram_hashes(codes, q)
        grams = [t[i : i + q] for i in range(len(t) - q + 1)]
        assert len(h) == len(grams)
        assert all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(len(h)))
    assert len(decontamination.gram_hashes(np.zeros(0, np.uint64), 3)) == 0


def test_sender_follows_its_strings():
    """A flush with a hundred times the buckets takes about as long, and every string comes back."""
    import time

    import numpy as np

    n, took = 20_000, {}
    strings = [b"some words of a window %d" % i for i in range(n)]
    for buckets in (10_000, 1_000_000):
        best = float("inf")
        for _ in range(3):
            sender = substring_dedup._Sender(buckets)
            at = (substring_dedup.mix(np.arange(n, dtype=np.uint64)) % np.uint64(buckets)).astype(np.int64)
            sender.put(at[: n // 2], np.arange(n // 2), np.zeros(n // 2, np.int64), strings[: n // 2])
            sender.put(at[n // 2 :], np.arange(n // 2, n), np.zeros(n - n // 2, np.int64), strings[n // 2 :])
            began = time.perf_counter()
            batches = list(sender.flush())
            best = min(best, time.perf_counter() - began)
        took[buckets] = best
        zstd, got = substring_dedup.zstandard.ZstdDecompressor(), {}
        for b in batches:
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("packed").to_pylist(), strict=True):
                doc, _, words = substring_dedup._unpack(blob, zstd, True)
                got |= {d: (bucket, w) for d, w in zip(doc.tolist(), words, strict=True)}
        assert got == {i: (int(at[i]), strings[i]) for i in range(n)}
    assert took[1_000_000] < 5 * took[10_000] + 0.5


def test_decontamination_in_parts(make, spark, monkeypatch):
    """A benchmark larger than a part is searched for whole: the same rows, and the same documents left."""
    r = random.Random(11)
    word = lambda: r.choice(["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf"]) + str(r.randrange(99))
    items = [" ".join(word() for _ in range(12)) for _ in range(30)] + ["short one", None, ""]
    items.append(items[3])
    docs = [" ".join([word(), items[i % 30] if i % 3 else word(), word()]) for i in range(60)] + [None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    d = make(docs)
    rows = lambda: sorted(map(tuple, decontamination.leaks(d, bench).collect()))
    left = lambda: sorted(x.doc_id for x in decontamination.clean(d, bench).collect())
    want = rows(), left()
    assert len(want[0]) > 30 and 10 < len(want[1]) < 40
    monkeypatch.setattr(decontamination, "PART_CHARS", 400)
    assert len(list(decontamination._parts(bench, "item_id", "text"))) > 4
    assert (rows(), left()) == want
    assert decontamination.leaks(d, bench.where("false")).collect() == [] and decontamination.clean(d, bench.where("false")).count() == len(docs)
