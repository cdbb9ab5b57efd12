"""Resampling by a CRC ring, substrings by compacted paths and fill-in-middle, against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from tessella.llm import fill_in_middle, html_text, max_score, near_duplicates, pii, substrings, target_resampling, url_filter
from tessella.llm.page_samples import labelled_pages

WORDS = "alpha beta Gamma délta o_mega 42 sigma kappa lambda theta".split()


def _text(r, n):
    return " ".join(r.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text): plain, copied, empty, null, marked and very long texts; ties, shared ids, repeated rows and no id."""
    r = random.Random(11)
    out = [(i, _text(r, 60)) for i in range(40)]
    base = out[7][1]
    out += [(40, base), (41, ""), (42, None), (43, "a <P> mark"), (44, "x\r\n\0é😀 y" * 9), (45, _text(r, 30_000)), (46, "A" * 5000), (47, "one, two"), (7, base), (7, _text(r, 33)), (None, base), (None, None), (48, base + " end")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x", 1) for i, t in rows], "doc_id bigint, text string, n int, rank string, weight int").repartition(3)


def _plain_resampling(rows, target):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    own = [(i, *features(t)) for i, t in rows]
    s, t = collections.Counter(b for *_, f in own for b in f), collections.Counter(b for x in target for b in features(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((o for o in out if o[5] >= 20), key=lambda o: (-o[3], o[0] is None, o[0] or 0, -o[1]))
    for k, o in enumerate(able[: 5 * len(able) // 100]):
        o[4] = k + 1
    return sorted(map(str, (o[:5] for o in out)))


def test_resampling_against_brute_force(spark, docs, rows):
    target = [(None,), ("",), ("alpha beta gamma 42",), ("Sigma délta sigma",)]
    got = target_resampling.resample(docs, spark.createDataFrame(target, "text string"))
    have = sorted(str([r.doc_id, r.n_features, r.weight, r.score, r.rank]) for r in got.collect())
    assert have == _plain_resampling(rows, [t for (t,) in target])


def test_ranks_of_a_larger_share_and_of_ties(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(500)], "score int, doc_id int").repartition(5)
    got = target_resampling.ranked(rows, [rows.score.desc(), rows.doc_id.asc()])
    assert [(r.score, r.doc_id) for r in sorted(got.collect(), key=lambda r: r["rank"])] == sorted(((i % 7, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 501))


def _plain_middle(i, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    d = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((d[0] % (len(tokens) + 1), d[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or d[2] % 100 >= 90:
        return i, len(tokens), "plain", None, None, text, text
    if d[3] % 100 < 20:
        return i, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return i, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fill_in_middle_against_brute_force(docs, rows, monkeypatch):
    want = sorted(str(_plain_middle(*r)) for r in rows)
    for together in (fill_in_middle.TOGETHER, 100):  # slices of one row too
        monkeypatch.setattr(fill_in_middle, "TOGETHER", together)
        got = fill_in_middle.transform(docs).collect()
        assert sorted(str(tuple(r)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    digests = {(r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in fill_in_middle.transform(docs, digests=True).collect()}
    assert digests == {(r.doc_id, r.form, sha(r.output), sha(r.restored)) for r in got}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert fill_in_middle.transform(none).isEmpty()
    assert target_resampling.resample(none, none).isEmpty()


def _plain_substrings(rows, width=13):
    words = [(i, re.findall("[^ \t-\r]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - width + 1):
                e = tuple(w[k : k + width])
                first[e] = min(i, first.get(e, i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def passages():
    """Passages that begin, end, overlap, nest, repeat inside one text, and stand at either end; periods; shared ids and rows without id."""
    r = random.Random(5)
    fresh = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    base, hot = fresh(90).split(), fresh(25)
    out = [(i, f"{fresh(20)} {hot}\t\t{fresh(20)}") for i in range(60)]
    out += [(100 + i, " ".join(base[a:b])) for i, (a, b) in enumerate([(0, 50), (40, 90), (0, 90), (20, 33), (20, 32), (5, 60)])]
    out += [(120, " ".join(base[:40] + ["changed"] + base[41:])), (121, "ab " * 40), (122, "ab " * 13 + "end"), (123, " ".join([*base[30:50], *base[30:50]])), (124, "  " + " ".join(base) + " ")]
    out += [(101, " ".join(base)), (101, " ".join(base)), (99, fresh(200)), (None, " ".join(base)), (130, None), (131, ""), (132, "one"), (133, " ".join(WORDS * 300)), (134, " ".join(r.choices("a b".split(), k=400))), (135, " ".join(r.choices("a b".split(), k=400)))]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seen", [8, 1, 10**9])  # the usual way, every anchor hot, none hot
def test_substrings_against_brute_force(spark, passages, monkeypatch, seen):
    monkeypatch.setattr(substrings, "SEEN", seen)
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    docs = spark.createDataFrame([(i, t, 1, "f", 2) for i, t in passages], "doc_id bigint, text string, g int, f string, at int").repartition(3)
    removed = lambda s: sum(s[1::2]) - sum(s[::2])
    got = substrings.remove_repeated(docs, with_text=True).collect()
    assert sorted(str((r.doc_id, r.n_words, removed(r.spans), r.kept_sha256)) for r in got) == _plain_substrings(passages)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_paths_are_compact_and_hold_the_same_words(spark, passages):
    docs = spark.createDataFrame(passages, "doc_id bigint, text string")
    texts = collections.defaultdict(set)
    for i, t in passages:
        texts[i].add(tuple((t or "").split()))
    found = collections.defaultdict(list)
    for r in substrings.repeated_paths(docs).collect():
        found[r.path].append(r)
    for rows in found.values():
        held = [{w[r.start : r.start + r.words] for w in texts[r.doc_id]} for r in rows]
        assert len({r.doc_id for r in rows}) > 1 and set.intersection(*held)
    assert max(r.words for rows in found.values() for r in rows) >= 25  # the passage of sixty texts is one path
    assert sum(len({r.doc_id for r in rows}) == 60 for rows in found.values()) <= 3


def test_substrings_of_an_empty_table(spark):
    assert substrings.remove_repeated(spark.createDataFrame([], "doc_id bigint, text string")).isEmpty()


def test_the_quality_stage_keeps_texts_without_words(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(2)
    rows = [(i, _text(r, 30) if i % 2 else _text(r, 30).upper(), "en", "web", 1) for i in range(60)] + [(100, None, "en", "web", None), (101, "", "en", "web", 0), (None, "", "en", "web", 0)]
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(x.doc_id, x.text) for x in corpus_pipeline.keep_quality(spark, docs, str(tmp_path)).collect()]
    assert {(100, None), (101, ""), (None, "")} <= set(kept) and len(kept) < len(rows)


def test_kept_of_near_duplicates_is_the_row_of_the_component(spark, tmp_path):
    base = _text(random.Random(1), 60)
    rows = [(5, base), (5, base + " zz"), (8, base), (9, "other words"), (None, "no id"), (7, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = near_duplicates.op7_near_duplicates(spark, str(tmp_path)).collect()
    assert sorted(str((x.doc_id, x.component_id, x.kept)) for x in got) == sorted(map(str, [(5, 5, True), (5, 5, True), (8, 5, False), (9, 9, True), (None, None, True), (7, 7, True)]))


def test_top_k_counts_repeated_rows(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, [r.randint(-3, 3) / 2 for _ in range(4)]) for i in range(50)]
    rows += [rows[3]] * 30 + [rows[20]] * 2 + [(20, [1.0, 0.5, 0.0, 0.0]), (None, [1.0] * 4), (60, None), (61, [1.0, None, 0.0, 0.0]), (62, [float("nan")] * 4)]
    spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, id int").write.parquet(f"{tmp_path}/embeddings.parquet")
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and x == x for x in v)]
    want = collections.defaultdict(list)
    for q, v in {(i, tuple(v)) for i, v in usable if i % 20 == 0}:
        want[q] += [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q]
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in max_score.op4_max_score(spark, str(tmp_path)).collect())
    assert got == sorted((q, k + 1, i, -s) for q, found in want.items() for k, (s, i) in enumerate(sorted(found)[:20]))
    assert sum(x[2] == 3 for x in got) > 20 and max_score.top_k(*[spark.createDataFrame([], "id bigint, v array<bigint>")] * 2).isEmpty()


def test_url_list_decides_between_pages_of_one_host(spark):
    page = lambda i, url, html: (i, url, html, "x", "y")
    ad, no = '<div class="ad">', "<p>"
    rows = [page(0, "http://spam-farm.com/a/", ad), page(1, "https://spam-farm.com/a?q", no), page(2, "http://spam-farm.com/b", no), page(3, "http://other.com/c", ad), page(4, "http://www.spam-farm.com/d", None), page(5, None, ad), page(6, "http://x.spam-farm.org/fr/1", ad), page(6, "http://x.spam-farm.org/fr/1", ad)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, listed string")
    out = sorted((r.page_id, r.verdict, r.listed) for r in url_filter.judge(df, url_filter.advert_list(df)).collect())
    assert out == [(0, "block", True), (1, "block", True), (2, "allow", False), (3, "allow", False), (4, "allow", False), (5, "allow", False), (6, "allow", True), (6, "allow", True)]
    none = url_filter.judge(df, df.limit(0).select("url"))
    assert none.where("listed").isEmpty() and none.count() == 8 and url_filter.judge(df.limit(0), df.select("url")).isEmpty()


def test_a_key_is_asked_for(spark):
    df = spark.createDataFrame([(1, "call 555-123-4567")], "doc_id bigint, text string")
    spark.conf.unset(pii.KEY_SETTING)
    with pytest.raises(ValueError, match="secret key"):
        pii.pseudonymise(df)
    one = pii.pseudonymise(df, "a").first().text
    assert one == pii.pseudonymise(df, "a").first().text != pii.pseudonymise(df, "b").first().text
    key = pii.with_key(spark).conf.get(pii.KEY_SETTING)
    assert len(key) == 64 and pii.with_key(spark).conf.get(pii.KEY_SETTING) == key and pii.pseudonymise(df).first().text != df.first().text
    spark.conf.unset(pii.KEY_SETTING)


def test_more_forms_of_cards_phones_dates_accounts_and_tokens(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    found = ["3782 822463 10005", "3782-822463-10005", "01 23 45 67 89", "01.23.45.67.89", "030 12345678", "0171/1234567", jwt, "password: correcthorsebattery", "15.3.2024", "2024/03/15", "gb82west12345698765432", "bob@exämple.de"]
    left = ["01 23 45 67 89 01", "3782 822463 10006", "31.2.2024", "2024/13/15", "gb82west12345698765433", "password: needed", "my password is correcthorsebattery", "eyJust.a.name", "chapter 01 23"]
    same = [["GB82WEST12345698765432", "gb82west12345698765432", "GB82 WEST 1234 5698 7654 32"], ["2024-03-15", "2024/03/15", "15.03.2024", "15.3.2024"]]
    texts = [f"<{v}>" for v in found] + left + [v for g in same for v in g]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1), "k").orderBy("doc_id").collect()]
    for a, b in zip(found, out, strict=False):
        assert b[1:-1] != a and (len(b) == len(a) + 2 or a == "15.3.2024") and [c.isalnum() for c in b] == [c.isalnum() for c in f"<{a}>"] or a == "15.3.2024"
    assert out[len(found) : len(found) + len(left)] == left
    ibans, dates = out[-7:-4], out[-4:]
    assert len({x.replace(" ", "").upper() for x in ibans}) == 1 and ibans[1].islower()
    y, m, d = dates[0].split("-")
    assert dates == [f"{y}-{m}-{d}", f"{y}/{m}/{d}", f"{d}.{m}.{y}", f"{int(d)}.{int(m)}.{y}"]


def test_short_and_plain_pages_written_by_hand():
    field = html_text.default_field()
    pages = {
        "<p>One para only.</p>": "One para only.",
        "<html><body><p>One para only.</p></body></html>": "One para only.",
        "<table><tr><td>Nine words stand here in one cell of it.</td></tr></table>": "Nine words stand here in one cell of it.",
        "<body><h1>Title</h1><p>Short text here.</p><p>Another one.</body>": "Title\nShort text here.\nAnother one.",
        "Just text": "Just text",
        '<body><nav><a href="/">Home</a></nav><p>Short text.</p><footer>&copy; me</footer></body>': "Short text.",
        '<body><div class="menu"><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></div><table><tr><td>Price</td><td>12 &euro;</td></tr></table><div class="cookie-notice">We use cookies.</div>': "Price\n12 €",
        '<body><header><h1>My site</h1></header><main><p>Yes.</p></main><aside><p>See also this long story about nothing at all.</p></aside>': "Yes.",
    }
    assert {p: field.extract(p) for p in pages} == pages


def test_viterbi_against_all_labellings():
    r = random.Random(6)
    field = html_text.default_field()
    for page in labelled_pages(40, seed=77):
        found = html_text.blocks(page, html_text.Node("", None, frozenset(), False))[:11]
        own = html_text.Field(field.weights, np.array([[r.gauss(0, 2) for _ in range(2)] for _ in range(2)]))
        scores = [field.weights.get("bias", 0.0) + sum(field.weights.get(f, 0.0) for f in [*path, *html_text.text_features(t, linked)]) for t, path, linked in found]

        def worth(labels, scores=scores, pairs=own.pairs):
            return sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(pairs[a][b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=len(found)), key=worth) if found else ()
        short = html_text.blocks
        try:
            html_text.blocks = lambda *_, found=found: found
            assert own.extract(page) == "\n".join(t for (t, *_), y in zip(found, best, strict=True) if y)
        finally:
            html_text.blocks = short


def test_pages_of_any_form(spark):
    long = "<article>" + "".join(f"<p>Paragraph number {i} of a long page.</p>" for i in range(20_000))
    rows = [(1, "u", long), (2, "u", "<p>Twice.</p>"), (2, "u", "<p>Twice.</p>"), (None, None, "<p>No id.</p>"), (3, "u", "<div class='ad"), (4, "u", "\0<p>\0x</p>")]
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = [(x.page_id, x.text) for x in html_text.main_text(df).collect()]
    assert got.count((2, "Twice.")) == 2 and (None, "No id.") in got and (3, "") in got and len(next(t for i, t in got if i == 1).split("\n")) == 20_000
