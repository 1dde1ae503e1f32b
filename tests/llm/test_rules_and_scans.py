import re

import duckdb
import pytest

from aqgrid.llm import language_id, quality_rules, queries, secret_scan, url_filter
from aqgrid.llm.common import written
from aqgrid.llm.url_filter import UrlRule


def plain_measures(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    often = {w for w in set(wins) if wins.count(w) > 1}
    cov = {p for i, w in enumerate(wins) if w in often for p in (i, i + 1, i + 2)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cov)


ODD = [None, "", " \n\t ", "a", "a b", "a b c a b c", "x y z\nx y z\nx y z\n", "##** a|b <c>", "wörd one\x1ctwo three", "a a a a a", "q " * 3000, "\x0b\x0cv w"]


def test_quality_measures_match_plain(make):
    got = quality_rules.quality_rules(make(ODD, n_words="clash")).orderBy("doc_id").collect()
    for t, r in zip(ODD, got, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(t), t
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_rules_are_native_and_can_be_empty(make, spark):
    df = quality_rules.quality_rules(make(["a b c"]), rules=())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert df.first().broken == []
    assert quality_rules.quality_rules(make([])).count() == 0


def test_repeated_rows_and_null_ids_keep_their_rows(make):
    d = make(["a b c d"] * 3, [1, 1, None])
    assert quality_rules.quality_rules(d).count() == 3
    assert secret_scan.digest(d).count() == 3


def test_good_text_is_kept(documents, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = written(quality_rules.quality_rules(documents), "quality").join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert out.where("kept").count() >= 0.95 * out.count()


def test_base_spans_match_plain(rows):
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = [*rows.values(), "AKIA" + "A" * 14, "AKIA" + "B" * 13, 'API_KEY="abcdefghijkl"', "ſecret=abcdefghijklmn toKen : abcdefghijk", "é" * 5 + "deadbeefdeadbeef0"]
    for t in texts:
        want = [(m.start(), m.end(), "assign") for m in a.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert secret_scan.base_spans(t) == sorted(want, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


def test_weak_parts_need_a_complement():
    key = "aB3" * 12
    alone = f"some {key} here"
    assert secret_scan.scan(alone) == ([], [])
    both = f"user = alice\nkey {key}\nhost = db.example.org"
    kinds = [s[2] for s in secret_scan.scan(both)[1]]
    assert kinds == ["id", "key", "endpoint"]
    far = "user = alice " + "x " * 400 + key
    assert secret_scan.scan(far) == ([], [])
    lone = "see https://example.org/page and user = bob"
    assert secret_scan.scan(lone) == ([], [])


@pytest.mark.parametrize("gap", [",", "\t", " ", "\n"])
def test_an_access_identifier_links_a_key_without_colons(make, gap):
    access, key = "AKIA" + "A1B2" * 4, "aB3/" * 10
    text = f"x {access}{gap}{key} y"
    strong, weak = secret_scan.scan(text)
    assert [s[2] for s in strong] == ["access"]
    assert [(text[a:b], k) for a, b, k in weak] == [(key, "key")]
    assert secret_scan.scan(text + " " * 400 + ":") == (strong, weak)
    assert secret_scan.redact(make([text])).first().text == f"x [secret]{gap}[secret] y"


def test_the_shortcut_of_the_weak_scan_loses_nothing():
    import random

    r = random.Random(8)
    parts = ["AKIA" + "A1B2" * 4, "aB3/" * 10, "deadbeef" * 2, "user=bob", "host: a.example", "s3://bucket/x", "token=abcdefghijkl", "word", ",", "\n", " "]
    for _ in range(500):
        text = "".join(r.choice(parts) + r.choice(" ,\n") for _ in range(r.randrange(1, 6)))
        strong = secret_scan.base_spans(text)
        assert secret_scan.scan(text) == (strong, secret_scan.linked(strong, secret_scan.weak_spans(text), 200)), text


def test_weak_links_match_all_pairs(rows):
    import random

    r = random.Random(5)
    for _ in range(200):
        spans = [(a := r.randrange(2000), a + r.randrange(1, 40), r.choice(secret_scan.KINDS)) for _ in range(r.randrange(12))]
        strong = [s for s in spans if s[2] in ("assign", "access", "hex")]
        weak = secret_scan.ordered([s for s in spans if s not in strong])
        over = lambda x, y: x[0] < y[1] and y[0] < x[1]
        part, comp = secret_scan.PART, secret_scan.COMPLEMENT
        want = [
            s
            for s in weak
            if not any(over(s, t) for t in strong) and any(part[t[2]] in comp[part[s[2]]] and not over(s, t) and t[0] <= s[1] + 200 and t[1] >= s[0] - 200 for t in spans)
        ]
        assert secret_scan.linked(strong, weak, 200) == want


def test_scan_end_to_end_matches_all_pairs(make):
    """Every kind of part in random order, without any shortcut: all candidates against all."""
    import random

    r = random.Random(21)
    parts = ["AKIA" + "A1B2" * 4, "aB3/" * 10, "deadbeef" * 2, "user=bob", "host: a.example", "s3://bucket/x", "token=abcdefghijkl", "word " * 30, "login : eve", "Zz9" * 14]
    texts = [r.choice(["", ":", "="]) + "".join(r.choice(parts) + r.choice([" ", ",", "\n", " " * 150]) for _ in range(r.randrange(1, 9))) for _ in range(150)]
    over = lambda x, y: x[0] < y[1] and y[0] < x[1]
    got = {x.doc_id: [(s["start"], s["end"], s["kind"]) for s in x.spans] for x in secret_scan.scan_secrets(make([*texts, texts[0]], spans="x")).collect()}
    for d, t in enumerate([*texts, texts[0]]):
        strong, weak = secret_scan.base_spans(t), secret_scan.weak_spans(t)
        part, comp = secret_scan.PART, secret_scan.COMPLEMENT
        linked = [
            w for w in weak
            if not any(over(w, s) for s in strong) and any(part[o[2]] in comp[part[w[2]]] and not over(o, w) and o[0] <= w[1] + 200 and o[1] >= w[0] - 200 for o in strong + weak)
        ]
        assert got[d] == secret_scan.ordered(strong + linked), t


def test_redaction(make):
    t = "x token = abcdefghijklmnop y"
    out = secret_scan.redact(make([t, None, "clean"])).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["x [secret] y", None, "clean"]


@pytest.mark.parametrize(
    ("url", "rule", "verdict"),
    [
        ("http://example.com/en/1", "example.com/en/", "block"),
        ("http://WWW.Example.com/en/1?x", "www.example.com/en/", "allow"),
        ("https://a.b.www.example.com/en/", "www.example.com/en/", "allow"),
        ("https://other.com/fr/1", "com/", "allow"),
        ("https://other.com", None, "allow"),
        ("https://badexample.com/en/1", "com/", "allow"),
        ("https://x.net/es/1", "net/es/", "block"),
        ("https://x.net/es", None, "allow"),
        ("https://x.net?/es/1", None, "allow"),
        ("no scheme", None, "allow"),
        (None, None, "allow"),
    ],
)
def test_url_rules(spark, url, rule, verdict):
    d = spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")
    r = url_filter.filter_urls(d, queries.URL_RULES).first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_odd_tables_of_urls(spark):
    d = spark.createDataFrame([(1, "http://a.com/x", "v"), (1, "http://a.com/x", "v"), (None, None, None)], "page_id long, url string, verdict string")
    rows = url_filter.filter_urls(d, queries.URL_RULES).collect()
    assert sorted((r.page_id or 0, r.host, r.rule, r.verdict) for r in rows) == [(0, "", None, "allow"), (1, "a.com", "com/", "allow"), (1, "a.com", "com/", "allow")]
    assert url_filter.filter_urls(d.limit(0), queries.URL_RULES).count() == 0
    assert {(r.rule, r.verdict) for r in url_filter.filter_urls(d, [], default="block").collect()} == {(None, "block")}


def test_trie_matches_every_rule_in_turn():
    import itertools
    import random

    r = random.Random(3)
    hosts = [".".join(p) for n in (1, 2, 3) for p in itertools.product("abc", repeat=n)]
    paths = ["/", "/x", "/x/", "/x/y", "/xy/", ""]
    for _ in range(60):
        rules = [UrlRule(r.choice(["allow", "block"]), r.choice(hosts), r.choice(paths)) for _ in range(12)]
        trie = url_filter.Trie(rules)
        for _ in range(40):
            h, p = r.choice(hosts), r.choice([*paths, "/x/y/z", "/xyz", "/q"])
            fit = [x for x in rules if (h == x.host or h.endswith("." + x.host)) and p.startswith(x.path)]
            want = max(fit, key=url_filter._rank, default=None)
            assert trie.match(h, p) == want


def test_suffix_automaton_accepts_substrings_only():
    import numpy as np

    text = np.array([1, 2, 1, 1, 2, 3, 1, 2])
    nxt = language_id.suffix_automaton(text)

    def accepts(w):
        s = 0
        for c in w:
            if c not in nxt[s]:
                return False
            s = nxt[s][c]
        return True

    subs = {tuple(text[i:j]) for i in range(8) for j in range(i + 1, 9)}
    import itertools

    for n in (1, 2, 3, 4):
        for w in itertools.product((1, 2, 3), repeat=n):
            assert accepts(w) == (w in subs)


def test_phrases_match_greedy_parsing():
    m = language_id.Model({"a": ("the cat sat on the mat " * 3,), "b": ("le chat est sur le tapis " * 3,)})
    for text in ["the mat sat", "xyz cat", "le tapis", "q"]:
        codes = m.alphabet.codes(text)
        for j, k in enumerate(m.langs):
            learned = (" ".join({"a": ["the cat sat on the mat " * 3], "b": ["le chat est sur le tapis " * 3]}[k]))
            learned = learned[: len(learned) * 9 // 10]
            corpus = bytes(m.alphabet.codes(learned[: min(len(learned), 10**9)]).tolist())
            n, at = 0, 0
            c = bytes(codes.tolist())
            while at < len(c):
                size = 1
                while at + size < len(c) and c[at : at + size + 1] in corpus and c[at : at + size] in corpus:
                    size += 1
                n, at = n + 1, at + size
            got = m._parse([codes])[0][j]
            assert abs(got - n) <= 1


def test_language_accuracy_and_odd_texts(spark, documents, make, sf):
    out = queries.op8_language_id(spark, sf)
    both = out.join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in both if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in both)
    model = language_id.train(documents)
    odd = language_id.identify(make([None, "", "123 !!", "the and of " * 5000], lang_pred="x"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in odd] == ["und", "und", "und", "en"]
    assert language_id.train(documents.where("lang is null")) == ()
    assert language_id.identify(make(["abc"]), ()).first().lang_pred == "und"
    assert language_id.identify(make([]), model).count() == 0


def test_labels_are_no_input(documents):
    model = language_id.train(documents)
    a = language_id.identify(documents, model).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect()
    from pyspark.sql import functions as F

    b = language_id.identify(documents.withColumn("lang", F.lit("zz")), model).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect()
    assert a == b


def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("op1_quality_rules", "op3_url_filter", "op5_substring_dedup", "op6_ngram_join", "op10_warc"):
        df = queries.QUERIES[name](spark, sf)
        cur = con.execute(queries.ORACLES[name])
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(repr, df.select(*cols).toPandas().astype(object).where(lambda d: d.notna(), None).itertuples(index=False, name=None))) == sorted(
            map(repr, con.execute(queries.ORACLES[name]).fetch_df().astype(object).where(lambda d: d.notna(), None).itertuples(index=False, name=None))
        ), name


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def invented(letters, n, seed):
    import random

    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(60)]
    return " ".join(r.choice(words) for _ in range(n))


def test_a_language_of_long_or_mostly_null_texts_is_learned(spark):
    rows = [(i, invented("abcdefgh", 100, 1), "short") for i in range(3)]
    rows += [(100 + i, "1 " * 15_000 + invented("mnopqrst", 5_000, i), "books") for i in range(3)]
    rows += [(1_000 + i, None if i else invented("uvwxyzij", 2_000, 7), "nulls") for i in range(3_000)]
    rows += [(5_000 + i, invented("ghijklmn", 2_000, 9), "copies") for i in range(2_000)]
    model = dict(language_id.train(labelled(spark, rows)))
    assert sorted(model) == ["books", "copies", "nulls", "short"]
    assert all(any(c.isalpha() for c in t) for v in model.values() for t in v)
    assert max(len(t) for v in model.values() for t in v) <= language_id.WINDOW
    assert len(model["copies"]) == 1


def test_every_label_is_learned(spark):
    import itertools

    sets = list(itertools.islice(itertools.combinations("abcdefghijklmnopqrstuvwxyz", 4), 0, 14_000, 350))
    d = labelled(spark, [(k, invented(x, 400, k), f"l{k:02}") for k, x in enumerate(sets)] + [(99, "zq yx", "tiny")])
    model = language_id.train(d)
    assert len(model) == 41
    got = language_id.identify(d.where("lang <> 'tiny'"), model).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 39


def test_large_alphabets_are_told_apart(monkeypatch):
    han = [chr(0x4E00 + k) for k in range(400)]
    texts = {"a": (invented("abcdefgh", 3_000, 1),), "x": (invented(han[:250], 3_000, 2),), "y": (invented(han[150:], 3_000, 3),)}
    m = language_id.Model(texts)
    assert [t.dense for t in m.tables] == [True, False, False]
    ask = [invented(s, 200, k) for k, s in ((1, "abcdefgh"), (2, han[:250]), (3, han[150:]))]
    assert m.predict(ask)[0] == ["a", "x", "y"]
    monkeypatch.setattr(language_id, "DENSE_CLASSES", 1_000)
    dense = language_id.Model(texts)
    assert all(t.dense for t in dense.tables) and (dense.rates(ask) == m.rates(ask)).all()


def test_language_of_long_texts_in_slices(make, monkeypatch):
    """Slices change nothing; a text far over a slice takes no more arrays than one slice needs."""
    import tracemalloc

    import numpy as np

    texts = {"en": ("the quick brown fox jumps over the lazy dog and then runs home again. " * 40,), "de": ("der schnelle braune fuchs springt über den faulen hund und läuft heim. " * 40,)}
    m = language_id.Model(texts)
    cases = ["", "  ,, ", "the fox -- 12 ", "über" + " ," * 900 + "den hund", texts["de"][0] + ", " * 700 + texts["en"][0], "x" * 3000]
    want = m.rates(cases)
    monkeypatch.setattr(language_id, "SLICE", 333)
    np.testing.assert_allclose(m.rates(cases), want)
    monkeypatch.undo()
    peaks = []
    for n in (1, 8):
        long = texts["en"][0] * (n * 700)
        tracemalloc.start()
        m.rates([long])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0]


def test_language_labels_and_short_texts(make, spark):
    rows = [(i, f"w{i % 50} w{i // 50} ab", "en" if i % 2 else "de") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = dict(language_id.train(docs, sample_chars=3000))
    assert all(2500 < sum(map(len, v)) <= 3000 for v in got.values()) and set(got) == {"en", "de"}
    dirty = docs.withColumn("lang", docs.doc_id.cast("string"))
    with pytest.raises(ValueError, match="labels are more than"):
        language_id.train(dirty)
