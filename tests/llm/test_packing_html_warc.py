import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from aqgrid.llm import html_extract, packing, queries, warc


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


ODD = [
    None,
    "",
    "   \n\n ",
    "don't it's WE'RE İstanbul ΣΑΣ ΑΣ áb x ́ <|endoftext|> a<|endoftext|>b 中文字 ½ ² ª µ ÿ Ÿ × ÷ \x1c \x85 \xa0 tab\there cr\r\nlf '' 's 'S",
    "naïve café 123abc!!! ...",
    "word " * 9000,
]


def check_packing(rows, ids):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[d])
            part = np.array(ids[d][at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids[d])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    return sum(len(x) for x in ids.values()), 4096 * len(by_seq)


def test_packing_is_exact_and_tight(documents, rows):
    got = packing.pack(documents, queries.tokenizer_path()).collect()
    ids = dict(zip(rows, whole_ids(rows.values()), strict=True))
    tokens, room = check_packing(got, ids)
    assert tokens >= 0.97 * room


def test_packing_of_odd_texts(make):
    got = packing.pack(make(ODD, start="x", length="y"), queries.tokenizer_path()).collect()
    check_packing(got, dict(enumerate(whole_ids(ODD))))
    assert packing.pack(make([]), queries.tokenizer_path()).count() == 0
    assert packing.pack(make(["a", "a"], [1, None]), queries.tokenizer_path()).count() == 2


def test_small_caches_and_steps_give_the_same_ids(monkeypatch):
    import random

    r = random.Random(4)
    monkeypatch.setattr(packing, "STEP", 40)
    encoder = packing.WordEncoder(queries.tokenizer_path(), generation=5)
    pieces = ["don't", "WE'LL", "naïve", "x1y22", "###", "a_b", "<|endoftext|>", "<b>", "中文", "Ÿ", "é́", "\t", "\u2028", "''s", "½", "½ ", "ﬁ", "end."]
    texts = ["", None, " ", "\n", *(r.choice([" ", "\n", ""]).join(r.choice(pieces) for _ in range(r.randrange(40))) for _ in range(300))]
    for t, ids in zip(texts, whole_ids(texts), strict=True):
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == ids[:-1], t
    assert len(encoder.parts) <= 5 and len(encoder.parts.old) <= 5


def test_cuts_are_whole_and_fit_their_class():
    for n in range(1, 9000, 7):
        parts = packing.cut(n, 4096)
        assert sum(s for s, _ in parts) == n
        assert all(s * k <= 4096 for s, k in parts)


def test_first_fit_matches_plain():
    import random

    r = random.Random(2)
    for _ in range(50):
        sizes = sorted((r.randint(1, 100) for _ in range(r.randint(0, 40))), reverse=True)
        bins, rooms = [], []
        for i, s in enumerate(sizes):
            b = next((k for k, x in enumerate(rooms) if x >= s), len(rooms))
            if b == len(rooms):
                rooms.append(100)
                bins.append([])
            rooms[b] -= s
            bins[b].append(i)
        assert packing.first_fit(sizes, 100) == bins


@pytest.fixture(scope="module")
def model():
    return html_extract.default_model()


def test_blocks_and_references():
    page = "<p>a&amp;b  &lt;i&gt;\n c<p>d<script>x</script><br>e</p><!-- no --><ul><li>f<li>g</ul>tail"
    assert [b[0] for b in html_extract.blocks(page)] == ["a&b <i> c", "d e", "f", "g", "tail"]
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<p> </p>") == []
    assert [b[0] for b in html_extract.blocks("a < b <")] == ["a < b <"]


def test_held_out_layouts(model):
    pages = html_extract.labelled(200, 1234)
    right = sum(model.decode(html_extract.features(p)) == y for p, y in pages)
    assert right >= 0.95 * len(pages)


@pytest.mark.parametrize("layout", html_extract.LAYOUTS)
def test_layouts_that_training_never_saw(layout):
    model = html_extract.default_model(900, 7, tuple(x for x in html_extract.LAYOUTS if x != layout))
    hit = false = missed = 0
    for page, y in html_extract.labelled(100, 99, (layout,)):
        for got, want in zip(model.decode(html_extract.features(page)), y, strict=True):
            hit, false, missed = hit + (got and want), false + (got and not want), missed + (want and not got)
    assert 2 * hit / (2 * hit + false + missed) >= 0.96


@pytest.mark.parametrize(
    "page",
    ["<div>x" * 60_000, "<x1><x2>" * 30_000 + "</x3>" * 30_000, "<i class=ad>" * 30_000 + "<b class=ad>" * 30_000 + "</i>" * 30_000, "<table><td>" * 20_000 + "</p>" * 50_000, "<a " * 100_000 + '"', "<p>" * 50_000 + "</div>" * 50_000],
)
def test_deep_and_broken_pages_take_linear_time(model, page):
    import time

    began = time.perf_counter()
    html_extract.main_text(page + "<p>end", model)
    assert time.perf_counter() - began < 15


def test_repeated_pages_each_get_their_row(spark):
    page = "<nav><a href=/>x</a></nav><article><h1>Title</h1><p>Some words, and more of them.</p></article>"
    d = spark.createDataFrame([(1, "u", page, "x")] * 3 + [(2, "u", page, "y")], "page_id long, url string, html string, n_chars string")
    got = html_extract.extract(d).collect()
    assert sorted(r.page_id for r in got) == [1, 1, 1, 2] and {r.text for r in got} == {"Title\nSome words, and more of them."}


def test_viterbi_is_the_best_labelling(model):
    import itertools

    for page, _ in html_extract.labelled(30, 77):
        f = html_extract.features(page)[:8]

        def score(y, f=f):
            e = sum(model.gain.get(x, 0.0) for fs, v in zip(f, y, strict=True) if v for x in fs)
            return e + sum(model.trans[a, b] for a, b in zip(y, y[1:], strict=False))

        best = max(itertools.product((0, 1), repeat=len(f)), key=score)
        assert abs(score(best) - score(tuple(model.decode(f)))) < 1e-9


def test_gradient_is_right():
    x = np.random.default_rng(0).normal(size=(5, 2))
    trans = np.array([[0.3, -0.2], [0.1, 0.5]])
    import itertools

    of, place = np.array([0, 0, 0, 1, 1]), np.array([0, 1, 2, 0, 1])
    p, pair = html_extract._marginals(x, trans, of, place)
    want, want_pair = np.zeros((5, 2)), np.zeros((2, 2))
    for part in (slice(0, 3), slice(3, 5)):
        e = x[part]
        ys = list(itertools.product((0, 1), repeat=len(e)))
        w = np.array([np.exp(sum(e[k, v] for k, v in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False))) for y in ys])
        for y, q in zip(ys, w / w.sum(), strict=True):
            for k, v in enumerate(y):
                want[part][k, v] += q
            for a, b in zip(y, y[1:], strict=False):
                want_pair[a, b] += q
    assert np.allclose(p, want) and np.allclose(pair, want_pair)


def test_unclosed_markup_keeps_the_text():
    assert [b.text for b in html_extract.blocks("<p <b>one</b> two<p>three <a href='x>four")] == ["one two", "three <a href='x>four"]
    assert html_extract._is_empty("a=/ b /") and not html_extract._is_empty("href=/a/") and not html_extract._is_empty("href= /") and html_extract._is_empty('href="a"/')


def test_pages_of_the_table(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract(pages).collect():
        inside = [b[0] for b in html_extract.blocks(html[r.page_id]) if "article" in b[1]]
        assert r.text == "\n".join(inside) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_extract.extract(odd).collect()) == ["", ""]
    assert html_extract.extract(odd.limit(0)).count() == 0


def test_bundles_are_seekable(tmp_path):
    import zstandard

    w = warc.BundleWriter(str(tmp_path / "a" / "x.warc.zst"))
    records = [warc.build_record(i, f"http://h/{i}\r\nX: y", b"p" * i * 50, None if i % 3 else i + 1, "2020-01-01T00:00:00Z") for i in range(1, 400)]
    at = [w.put(r) for r in records]
    w.close()
    r = warc.BundleReader(str(tmp_path / "a" / "x.warc.zst"))
    assert len(r.frames) > 5 and list(r.records()) == records
    assert all(r.record(*at[i], len(records[i])) == records[i] for i in range(0, 398, 37))
    data = (tmp_path / "a" / "x.warc.zst").read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(records)


def test_archive_round_trip(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "u1", big), (2, None, big), (9, "u", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (9, "u", big), (6, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_archive(pages, str(tmp_path / "arc"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(index).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(p or 0, len((h or "").encode()), sha(h), "revisit" if h == big and p in (1, 2) else "response", 9 if h == big and p in (1, 2) else None) for p, _, h in rows]
    assert got == sorted(want, key=lambda x: x[:4] + (x[4] or 0,))
    one = warc.fetch(index, spark.createDataFrame([(4,)], "page_id long")).collect()
    assert len(one) == 1 and warc.parse_record(bytes(one[0].record))["payload"] == b"small"
    assert warc.read_archive(warc.write_archive(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_large_payloads_and_clashing_columns(spark, tmp_path):
    rows = [(k, f"u{k}", chr(97 + k % 5) * (400_000 if k % 3 else 90), "x", "y") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, payload string")
    index = warc.write_archive(pages, str(tmp_path / "arc")).cache()
    assert index.where("frame > 0").count() > 3
    back = warc.read_archive(index, payloads=True)
    assert back.rdd.getNumPartitions() == -(-index.selectExpr("bundle", f"frame DIV {warc.GROUP}").distinct().count() // warc.GROUPS_A_TASK)
    got = {r.page_id: r for r in back.collect()}
    last = {}
    for k, _, h, *_ in rows:
        last[h] = k
    for k, u, h, *_ in rows:
        revisit = len(h) >= 1000 and last[h] != k
        assert (got[k].url, got[k].payload_bytes, got[k].record_type, got[k].refers_to) == (u, len(h), "revisit" if revisit else "response", last[h] if revisit else None)
        assert got[k].payload == (None if revisit else h.encode())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a <svg class=icon />b</p><p>c</p>", ["a b", "c"]),
        ("<p>a</p><svg/><p>b</p><svg><text>x</text></svg><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><svg><p>b</p>", ["a", "b"]),
        ("<svg>x<svg>y</svg>z</svg><p>b</p>", ["b"]),
        ("<svg>x<svg/>z</svg><p>b</p>", ["b"]),
        ("<p>a</p><svg class=i><p>b</p><svg>x</svg><p>c</p>", ["a", "b", "c"]),
        ("<svg>x<!-- </svg> -->y<style>p::after { content: '</svg>' }</style>z</svg><p>b</p>", ["b"]),
        ("<svg href=/a/>x</svg><p>b</p>", ["b"]),
        ("<p>so <math class=m><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", ["so x=2 holds"]),
        ("<p>a</p><math/><p>b</p>", ["a", "b"]),
        ("<p>a</p><canvas><p>b</p>", ["a", "b"]),
        ("<p>a</p><video>x</video><p>b</p><video><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><script><p>b</p>", ["a"]),
    ],
)
def test_svg_math_and_tags_without_end(page, want):
    assert [b[0] for b in html_extract.blocks(page)] == want


def test_many_open_svg_take_linear_time():
    import time

    began = time.perf_counter()
    assert [b[0] for b in html_extract.blocks("<svg><canvas>" * 40_000 + "<p>b</p></svg><p>c</p>")] == ["c"]
    assert time.perf_counter() - began < 10


def test_repeated_rows_stay_once(spark, documents, sf):
    import random

    r = random.Random(6)
    text = lambda: " ".join(r.choice("abcdefghijkl") * r.randint(1, 9) for _ in range(60))
    hot, near, other = text(), text(), text()
    rows = [(1, hot)] * 300 + [(2, hot)] * 3 + [(5, near), (6, near + " end"), (6, near + " end")] + [(7, other), (7, text())] + [(None, text())] * 2 + [(k, text()) for k in range(100, 120)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], documents.schema).repartition(7)
    got = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    ids = [x.doc_id for x in got.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 5, 7, *range(100, 120)]
    assert ids.count(None) == 2
    assert {(x.doc_id, x.text) for x in got.collect()} <= set(rows)


def test_pipeline_stages(spark, documents, sf):
    from aqgrid.llm import decontamination, ngram_join, secret_scan

    docs = documents
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf).cache()
        assert docs.columns == documents.columns, name
        sizes.append(docs.count())
        if name == "near_duplicates":
            ids = {r.doc_id for r in docs.collect()}
            classes = ngram_join.ngram_join(before).collect()
            assert ids == {r.component_id for r in classes}
        if name == "secrets":
            assert secret_scan.scan_secrets(docs).where("size(spans) > 0").count() == 0
    assert sizes[1] >= 0.98 * sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[4] == sizes[3]
    assert decontamination.leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    out = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_of_odd_tables(spark, documents, sf, tmp_path):
    """Nulls in every column, empty texts, repeated rows and an empty table, through all stages."""
    odd = [(None, None, None, None, None), (None, "", "en", None, 0), (5, None, "en", "web", 3), (7, "   ", None, None, None)]
    docs = documents.limit(120).union(spark.createDataFrame(odd, documents.schema)).union(documents.limit(120))
    for name, table in (("odd", docs), ("none", documents.limit(0))):
        d = str(tmp_path / name)
        table.write.parquet(f"{d}/documents.parquet")
        spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        rows = out.collect()
        assert out.columns[:2] == ["doc_id", "start"]
        if name == "none":
            assert rows == []
        else:
            starts = [(r.doc_id, r.start) for r in rows if r.doc_id is not None]
            assert len(starts) == len(set(starts)) > 0  # a repeated row is packed once
            assert {r.doc_id for r in rows}.isdisjoint({5, 7, None} - {x.doc_id for x in documents.limit(120).collect()})
