"""Every operator against its plain definition, on small and awkward inputs."""

import base64
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from panelflow.llm import bpe, decontaminate, html, lines, lm, pii, quality, simhash, substring, toxicity
from tests.llm import brute


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def with_null_id(df):
    return [r for r in df.collect() if r.doc_id is None]


@pytest.fixture(scope="module")
def known(docs):
    """{doc_id: text} of the rows with an id."""
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}


def test_line_dedup(docs, known, empty):
    got, expected = lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_links", "text"), brute.lines(sorted(known.items()))
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r)[1:] == expected[r.doc_id], r.doc_id
    assert sorted(str(r.text) for r in rows if r.doc_id is None) == sorted(str(r.text) for r in with_null_id(docs.select("doc_id", "text")))
    assert lines.dedup_lines(empty).count() == 0
    kept = lines.drop_later_matches(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert {(r.n_chars, len(r.text or "")) for r in kept.collect() if r.doc_id is not None and r.text is not None} and all(
        r.n_chars == len(r.text) for r in kept.collect() if r.doc_id is not None and r.text is not None)


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_line_dedup_at_other_similarities(spark, similarity, monkeypatch):
    rng = random.Random(int(similarity * 10))
    rows = [(i, "\n".join(" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(4))) for i in range(40)]
    got = by_id(lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity))
    num, den = similarity.as_integer_ratio() if similarity != 0.8 else (4, 5)
    for k, e in brute.lines(rows, num, den).items():
        assert (got[k].n_lines, got[k].n_removed, got[k].n_links, got[k].text) == e
    monkeypatch.setattr(lines, "HOT", 3)
    less = by_id(lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity, links=False))
    assert all(less[k].text == got[k].text and less[k].n_removed == got[k].n_removed for k in got)


def test_line_dedup_orders_rows_that_repeat_an_id(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "a b c d e\nother"), (2, "a b c d e")]
    got = sorted((r.doc_id, r.n_removed, r.text) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got[-1] == (2, 1, "")
    assert sorted(n for k, n, _ in got if k == 1) in ([0, 0, 1], [0, 1, 1])       # equal rows are treated alike


def test_substring_dedup(docs, known, empty):
    got, expected = substring.dedup_substrings(docs).collect(), brute.windows(sorted(known.items()))
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.text) == expected[r.doc_id], r.doc_id
        else:
            assert r.n_removed == 0
    assert substring.dedup_substrings(empty).count() == 0


def test_substring_dedup_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_KEYS", 8)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 150)))) for i in range(40)]
    got = by_id(substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")))
    for k, e in brute.windows(rows).items():
        assert (got[k].n_words, got[k].n_removed, got[k].text) == e


def _toxic_corpus(n=600):
    rng = random.Random(9)
    plain, bad = [f"word{i}" for i in range(300)], ["vile", "rotten", "nasty"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_separates_held_out_rows(spark):
    rows, labels = _toxic_corpus()
    docs = spark.createDataFrame(rows + [(9999, None), (9999, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.report(docs, marks).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    label, held = dict(labels), [r for r in got if r.held_out and r.doc_id in dict(labels)]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert brute.area([r.score for r in held], [label[r.doc_id] for r in held]) > 0.97
    assert all(r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_never_sees_held_out_labels(spark):
    rows, labels = _toxic_corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, two = (toxicity.report(docs, spark.createDataFrame(m, "doc_id long, toxic int")).collect() for m in (labels, turned))
    assert sorted(one) == sorted(two)


def test_toxicity_keeps_columns_and_bears_missing_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored, out = toxicity.score(docs, none)
    assert out not in docs.columns and scored.drop(out).columns == docs.columns
    assert {r[out] for r in scored.collect()} == {0.5}
    assert toxicity.drop_toxic(empty, none).count() == 0


def test_decontamination(docs, known, empty, spark, texts):
    items = [(1, " ".join(texts[8].split()[3:40])), (2, "one"), (3, None), (None, "x"), (4, "!!"), (10, texts[8]), (5, texts[9].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, (n, hits, met) = decontaminate.contamination(docs, bench)
    assert found.count() == docs.count() and len({n, hits, met} & set(docs.columns)) == 0
    usable = [(i, t) for i, t in items if i is not None]
    for r in found.collect():
        assert (r[n], r[hits], r[met]) == brute.contamination(r.text, usable)
    assert any(r[hits] for r in found.collect())
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == found.where(f"size({hits}) = 0").count()
    assert decontaminate.drop_contaminated(empty, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.where("1 = 0")).count() == docs.count()


def test_decontamination_in_blocks(docs, spark, texts, monkeypatch):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts[8:20])], "item_id long, text string")
    whole = decontaminate.report(docs, bench).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    assert sorted(decontaminate.report(docs, bench).collect(), key=str) == sorted(whole, key=str)


def test_quality(docs, known, empty):
    for r in quality.report(docs).collect():
        if r.doc_id is not None:
            assert tuple(r)[1:7] == brute.quality(known[r.doc_id]), r.doc_id
            assert not (r.base_failed and r.kept)
    assert quality.report(empty).count() == 0


def test_quality_rules(spark):
    prose = "The old house by the river was sold to a man from the city, and he is now at work on it with his two sons. "
    cases = {prose: True, " ".join(w + "$$" for w in prose.split()): False, " ".join(f"zq{i}x" for i in range(60)): False, ("- of it\n- to the\n" * 20): False}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.report(df).collect()} == dict(enumerate(cases.values()))


PII = ["mail a.b+c@x-y.example.com or a@b.c_d@e.f, z@q@r.st", "1.2.3.4.5.6.7.8 256.1.1.1 00012.0.0.255 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111",
       "+1 (743) 555-3824 or +12345 and +49.30.1234567-", "é😀 a@b.co 😀+1 234 567 8901", "", None, "a@b" * 500, "1" * 3000, "1." * 1500, "a" * 20000 + "@x.y", "(743) 555-3824 tel 555-123-4567"]


def test_pii_base_spans(spark, docs, empty):
    rows = list(enumerate(PII))
    got = by_id(pii.report(spark.createDataFrame(rows + [(0, PII[0])], "doc_id long, text string")))
    for k, t in rows:
        spans = brute.pii(t)
        assert [got[k][f"n_{kind}"] for kind in pii.KINDS] == [sum(s[0] == kind for s in spans) for kind in pii.KINDS]
        listed = ["%s:%d:%d" % s for s in spans]
        assert got[k].base_sha256 == brute.sha(",".join(listed))
        assert set(listed) <= set(got[k].spans.split(",")) | {""}
    assert pii.report(docs).count() == docs.count()
    assert pii.report(empty).count() == 0


def test_pii_adds_likely_spans_only(spark):
    rng = random.Random(2)
    number = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(i, f"call phone +1 {number()} now, or size 12 x 40 of {rng.randint(10, 99)} parts") for i in range(200)]
    rows.append((1000, "my phone " + number()))
    got = by_id(pii.report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[1000].n_phone == 0 and got[1000].spans == "phone:9:23"
    assert all(got[i].spans.count(":") == 2 for i in range(200))          # sizes and parts stay


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB9.@+- ()_%:1é\n", max_size=60))
def test_pii_patterns_equal_the_plain_ones(text):
    """The possessive patterns and the plain ones find the same, by a model of both in Python's engine."""
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[ -]?[0-9])+"}
    for kind, pattern in plain.items():
        import regex
        own = [m.span() for m in regex.finditer(pii.BASE[kind], text)]
        assert own == [m.span() for m in re.finditer(pattern, text)], (kind, text)


def test_language_model(spark, docs, empty, monkeypatch):
    for name, value in (("WORDS_PER_SHARD", 50), ("PAIRS_PER_SHARD", 300), ("FLUSH", 2000)):
        monkeypatch.setattr(lm, name, value)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    cut = [(k, brute.words((t or "").translate(brute.LOWER))) for k, t in rows]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    p, uni = brute.kneser_ney([t for k, t in cut if not held(k)], lm.discounts)
    total = sum(uni.values())
    got = lm.report(docs).collect()
    assert len(got) == len(rows)
    expected = []
    for k, t in cut:
        t = t + ["</s>"]
        expected.append((str(k), held(k), len(t), sum(w in uni for w in t), total, sum(math.log10((uni.get(w, 0) + 1) / (total + len(uni) + 1)) for w in t),
                         sum(math.log10(p(w, h)) for h, w in zip(["<s>"] + t, t))))
    for a, b in zip(sorted((str(r[0]), *r[1:]) for r in got), sorted(expected)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)
    assert sum(p(w, "the") for w in uni) + p("unknown", "the") == pytest.approx(1)
    assert lm.report(empty).count() == 0


def test_language_model_without_anything_to_learn(spark):
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.report(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(docs, empty, library):
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == docs.count()
    ids = {}
    for r in docs.select("doc_id", "text").collect():
        ids.setdefault(r.doc_id, set()).add(tuple(library.encode_ordinary(r.text or "")))
    for r in rows:
        own = np.frombuffer(r.ids, "<u4")
        assert tuple(own.tolist()) in ids[r.doc_id] and r.n_tokens == len(own)
        assert r.ids_sha256 == brute.sha(bytes(r.ids)) and r.decoded_sha256 == brute.sha(library.decode_bytes(own.tolist()))
    assert bpe.round_trip(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_bpe_codec(texts):
    own = bpe.codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for t, ids in zip(texts, own.encode(texts)):
        assert own.decode(ids.astype(np.int64)) == t.encode()


def test_bpe_long_pieces_on_the_heap(library):
    own = bpe.codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(4)
    for piece in ("a" * 5000, "".join(rng.choice("abcdeé") for _ in range(6000)), "ß" * 3000):
        assert own.encode([piece])[0].tolist() == library.encode_ordinary(piece)


PAGE = ('<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></ul></nav>'
        '<!-- ad --><div class="ad box">Buy</div><article><h1>Head &amp; tail {0}</h1><p><b>One<br>two  \n three.<p>Four &#233; {0}</p><aside>Side</aside>'
        '<form><input><button>Send</button></form><div id="comments-list"><p>Me too</p></div></article><footer>&copy; x</footer>{1}')


def test_html_article(spark):
    rows = [(1, "https://h.example/a?x", PAGE.format(1, "</body></html>")), (1, "https://h.example/a?x", PAGE.format(1, "")), (2, None, None), (3, "", ""), (4, "x", "plain &lt;text&gt; &am")]
    got = html.extract_main_text(spark.createDataFrame([r + ("clash",) for r in rows], "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = "Head & tail 1\nOne\ntwo three.\nFour é 1"
    assert sorted((r.page_id, r.text, r.n_chars) for r in got.collect()) == [
        (1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "plain <text> &am", 16)]
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_style_tree_drops_what_a_site_repeats(spark):
    page = ('<html><body><div class="top">My site</div><div>About us and links</div><section><h2>Story {0}</h2><p>News number {1}</p></section>'
            '<div class="bottom">All rights reserved</div>' + "<p>" * 500)
    rows = [(i, f"http://one.example/{i}", page.format(i, i * 7)) for i in range(40)] + [(99, "http://two.example/", page.format(1, 2))]
    got = {r.page_id: r.text for r in html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3\nNews number 21"
    assert got[99].startswith("My site\nAbout us")            # one page tells nothing about its site


def test_html_style_tree_decides_inside_articles(spark):
    page = '<html><body><div>Top of site</div><article><h1>Story {0}</h1><p>News number {1}</p><p class="by">Written by our staff</p></article>'
    rows = [(i, f"http://one.example/{i}", page.format(i, i * 7)) for i in range(40)]
    rows += [(100 + i, f"http://two.example/{i}", page.format(1, 2)) for i in range(40)]          # one article on every page
    rows += [(200 + i, f"http://three.example/{i}", page.format(i // 20, i // 20)) for i in range(40)]     # two articles
    got = {r.page_id: r.text for r in html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3\nNews number 21"
    assert got[103] == "Story 1\nNews number 2\nWritten by our staff"
    assert got[203].startswith("Story 0\nNews number 0")


@pytest.mark.parametrize("body, text", [
    ('<div class="story"><p>The real story is told here</p></div><section id="comments"><article><p>Me too, and at greater length than the story itself</p></article></section>',
     "The real story is told here"),
    ('<div class="story"><p>The real story is told here</p></div><article class="card">Teaser</article>', "The real story is told here\nTeaser"),
    ('<div>Top</div><main class="has-sidebar"><p>Story</p></main>', "Story"),
    ('<div id="content" class="with-sidebar"><p>Story</p></div>', "Story"),
    ('<div>Top</div><article class="post share-enabled"><p>Whole story</p></article>', "Whole story"),
    ('<div class="sidebar layout"><article><p>Story</p></article></div><div class="sidebar">Side</div>', "Story"),
    ('<div class="widget"><div class="related-posts"><article>Other</article></div></div><article class="comment"><p>Story</p></article>', "Story"),
    ('<div class="comments"><main><p>Story</p><div class="social">Like</div></main></div>', "Story"),
    ('<nav class="menu"><article>Card</article></nav><p>Story</p>', "Story")])
def test_html_names_and_articles_in_noise(spark, body, text):
    got = html.extract_main_text(spark.createDataFrame([(1, "http://one.example/", f"<html><body class='has-sidebar'>{body}</body></html>")],
                                                       "page_id long, url string, html string"))
    assert got.first().text == text


def test_simhash(docs, known, empty):
    prints = {k: brute.fingerprint(t) for k, t in known.items()}
    roots = brute.components(prints)
    got = simhash.simhash_components(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", roots[r.doc_id])
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(roots.values()))
    assert len(with_null_id(kept)) == len(with_null_id(docs))
    assert simhash.simhash_components(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


def test_simhash_judges_rows_of_one_id_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, a), (2, c), (3, c), (3, b + " z"), (4, c), (5, None), (5, a)]
    prints = [brute.fingerprint(t) for _, t in rows]
    near = {i for i in range(len(rows)) if any((prints[i] ^ prints[j]).bit_count() <= 2 for j in (0, 1, 3))}
    assert {0, 1, 2, 3, 4, 6, 8} <= near and 7 not in near
    kept = sorted(map(tuple, simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    expected = [(1, a), (1, b), (2, c), (5, None)] + ([] if 5 in near else [rows[5]])
    assert kept == sorted(expected, key=str)


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_simhash_links_and_components(spark, distance):
    rng = random.Random(distance)
    prints = [0, -1, 1, 3, 7, -(1 << 63), -(1 << 63) | 1] + [rng.getrandbits(64) - (1 << 63) for _ in range(30)]
    for p in list(prints):
        for _ in range(3):
            q = p
            for _ in range(rng.randint(1, 4)):
                q ^= 1 << rng.randrange(63)
            prints.append(q)
    prints = sorted(set(prints))
    from panelflow.llm.components import connected_components
    got = {r.node: r.root for r in connected_components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), distance)).collect()}
    unsigned = {p: p & (2**64 - 1) for p in prints}
    expected = brute.components(unsigned, distance)
    groups = {}
    for p, r in expected.items():
        groups.setdefault(r, set()).add(p)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {
        frozenset(k for k, r in got.items() if r == root) for root in set(got.values())}
    if distance == 0:
        assert not got


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(500, 500)]
    from panelflow.llm.components import connected_components
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


def test_long_unrelated_lines_are_told_apart_by_their_signatures(spark, monkeypatch):
    import random

    from panelflow.llm import lines
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(2000)}" for _ in range(170)) for _ in range(40)]
    texts.append(texts[3].rsplit(" ", 4)[0])
    docs = spark.createDataFrame([(k, k, x) for k, x in enumerate(texts)], "doc_id long, same long, text string")
    tried, real = [], lines._verified

    def counted(docs, classes, pairs):
        tried.append(pairs.count())
        return real(docs, classes, pairs)
    monkeypatch.setattr(lines, "_verified", counted)
    assert lines.similar_lines(docs)[1].count() == 1
    assert lines.later_lines(docs)[1].count() == 1
    assert sum(tried) <= 10, tried


def test_near_copies_meet_under_few_of_the_ngrams_they_share(spark):
    import random

    from panelflow.llm import ngrams
    from panelflow.llm.common import id_and_text
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(30):
        words = list(base)
        words[rnd.randrange(150)] = f"x{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = ngrams.Join(id_and_text(docs, "doc_id", "text"))
    none = spark.createDataFrame([], "key long, label long")
    under: dict = {}
    for r in join.shared.collect():
        under.setdefault(r.gram, []).append((r.key, r.n, r.pos))
    met = [(max(x, y)[0], min(x, y)[0]) for v in under.values() for i, x in enumerate(v) for y in v[:i]]
    rows = [(r.a, r.b) for r in join.other_rows(none).select("a", "b").collect()]
    assert set(rows) == set(met)                        # no pair is lost
    assert len(rows) <= 1.2 * len(set(met)) < len(met) / 4


def test_drifting_near_copies_are_linked_by_comparisons_in_proportion(spark, monkeypatch):
    import random

    from panelflow.llm import ngrams
    rnd = random.Random(8)
    texts = [[f"w{k}" for k in range(400)]]
    for _ in range(499):                                # each a copy of one before it, so that many are not similar
        words = list(rnd.choice(texts))
        for _ in range(rnd.randint(1, 4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10 ** 6)}"
        texts.append(words)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    tried, real = [], ngrams.Join.linked

    def counted(self, pairs, name):
        pairs = self._keep(pairs, f"{name}-tried")
        tried.append(pairs.count())
        return real(self, pairs, name)
    monkeypatch.setattr(ngrams.Join, "linked", counted)
    got = sorted((tuple(r) for r in ngrams.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted(brute.ngram_components(rows), key=str)
    assert sum(tried) <= 10 * len(rows) and tried[-1] <= len(rows) / 10, tried


def test_links_of_a_group_of_near_copies_are_counted_not_listed(spark, monkeypatch):
    from panelflow.llm import lines
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 9])):
            words[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((k, " ".join(words) + "\n" + " ".join(f"y{rnd.randrange(30)}" for _ in range(8))))
    written, real = {}, lines._stored

    def counted(df, name):
        out = real(df, name)
        written[name] = out.count()
        return out
    monkeypatch.setattr(lines, "_stored", counted)
    got = by_id(lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    expected = brute.lines(rows)
    assert {k: (r.n_lines, r.n_removed, r.n_links, r.text) for k, r in got.items()} == expected
    links = sum(e[2] for e in expected.values()) // 2
    assert links > 5000 and written["line-links"] < links / 4, written


def test_training_holds_no_features_of_earlier_texts():
    import tracemalloc

    import pyarrow as pa
    rnd = random.Random(2)
    held = []

    def batches():
        for _ in range(60):
            texts = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(300)) for _ in range(50)]
            held.append(tracemalloc.get_traced_memory()[0])
            yield pa.RecordBatch.from_arrays([pa.array(texts), pa.array([k % 2 for k in range(50)], pa.int32())], ["text", "toxic"])
    tracemalloc.start()
    try:
        assert len(list(toxicity._train(batches()))) == 1
    finally:
        tracemalloc.stop()
    assert held[-1] - held[5] < 3_000_000, held        # 2,750 texts have some 10 MB of features


def test_round_trip_needs_one_worker_a_task(docs, capsys):
    bpe.round_trip(docs).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_classes_of_lines_are_stored_without_their_words(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(k, "\n".join(" ".join(f"w{rnd.randrange(5000)}" for _ in range(40)) for _ in range(3))) for k in range(30)]
    width, real = {}, lines._stored

    def counted(df, name):
        out = real(df, name)
        arrays = [c for c, kind in out.dtypes if kind.startswith("array")]
        width[name] = sum(len(r[c]) for r in out.select(*arrays).collect() for c in arrays) if arrays else 0
        return out
    monkeypatch.setattr(lines, "_stored", counted)
    got = by_id(lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: (r.n_lines, r.n_removed, r.n_links, r.text) for k, r in got.items()} == brute.lines(rows)
    assert width["line-classes"] <= 90 * 12 and sum(width.values()) <= 90 * 12, width      # of 40 words a line


def test_labels_and_shared_ngrams_are_sent_to_the_index_rows(spark, monkeypatch):
    from panelflow.llm import ngrams
    from panelflow.llm.common import id_and_text
    docs = spark.createDataFrame([(k, f"a b c d e f g h i j k l m n o p q r s t u v w x y{k}") for k in range(5)], "doc_id long, text string")
    join, plans, real = ngrams.Join(id_and_text(docs, "doc_id", "text")), {}, ngrams._stored

    def seen(df, path):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().toString()
        return real(df, path)
    monkeypatch.setattr(ngrams, "_stored", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = join._keep(join.places.select("key", "key").toDF("key", "label"), "own")
        assert join._mixed(labels, "second").count() == join.shared.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all("BroadcastHashJoin" in plans[f"second-{n}"] and "SortMergeJoin" not in plans[f"second-{n}"] for n in ("labelled", "mixed"))
