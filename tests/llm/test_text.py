"""Fingerprints, decontamination, mixing and HTML extraction on small fixtures."""

import hashlib
import random

import numpy as np
import pytest

from orrery.llm import decontaminate, fingerprint, htmltext, mixing


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, root string, bucket string, next_text string")


def edited(rows):
    """(id, text) in the defined order -> {id: edited text}."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        half = len(t) // 2
        out[i] = t[: len(t) - half] + nxt[:half]
    return out


def test_edited_texts_and_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET", 4)
    monkeypatch.setattr(fingerprint, "FAN", 2)
    rng = random.Random(1)
    ids = sorted(rng.sample(range(-40, 400), 50))
    rows = [(i, "".join(rng.choice("ab é😀.\n ") for _ in range(rng.randrange(120)))) for i in ids]
    rows[3] = (rows[3][0], None)
    rows[4] = (rows[4][0], "")
    rows[9] = (rows[9][0], rows[8][1])
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs_of(spark, rows)).collect()}
    want = edited(rows)
    assert {i: got[i].edited_sha256 for i in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert all(got[i].n_chars == len(t or "") for i, t in rows)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and len({f for s in by_text.values() for f in s}) == len(by_text)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_likeness_and_located_edits(spark):
    from pyspark.sql import functions as F

    lines = [f"Sentence {k} of this text. Another one {k * k}." for k in range(40)]
    changed = [*lines[:20], "A new line here.", *lines[21:]]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "a string, b string")
    df = fingerprint.add_tree(fingerprint.add_tree(df, "a", "a_"), "b", "b_")
    r = df.select(fingerprint.likeness("a_root", "a_sketch", "b_root", "b_sketch").alias("like"), fingerprint.changed_paragraphs("a_", "b_").alias("gone"), F.col("a_paragraphs"), "a_sections", "b_sections").first()
    assert r.like == pytest.approx(78 / 81, abs=0.02) and r.gone == [r.a_paragraphs[20]]
    assert len(set(r.a_sections) & set(r.b_sections)) >= len(r.a_sections) - 2


def located(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "doc_id long, a string, b string")
    df = fingerprint.add_tree(fingerprint.add_tree(df, "a", "a_", leaves=True), "b", "b_", leaves=True)
    out = {i: [] for i in range(len(pairs))}
    for r in fingerprint.located_edits(df.unionByName(df), "doc_id").collect():
        out[r.doc_id].append((r.kind, r.a_index, r.b_index, r.leaf_from, r.a_leaf_to, r.b_leaf_to))
    return {i: sorted(x, key=str) for i, x in out.items()}


def test_edits_are_located_by_descent(spark):
    lines = [f"Line {k} begins. It goes on to {k * k}. It ends." for k in range(60)]
    join = "\n".join
    edit = [*lines[:20], "Line 20 begins. It turns to ash. It ends.", *lines[21:]]
    swap = [*lines[:7], lines[9], lines[8], lines[7], *lines[10:]]
    twice = [*lines[:31], lines[30], *lines[31:]]
    cut = [*lines[:40], *lines[43:]]
    both = ["New first line.", *lines[:50], *lines[51:], "New last line.", "And one more."]
    got = located(spark, [(join(lines), join(x)) for x in (lines, edit, swap, twice, cut, both)] + [("", "a"), (None, "a"), ("a\n\na", "a\na")])
    assert got[0] == [] and got[1] == [("replaced", 20, 20, 1, 2, 2)]
    assert got[2] == [("replaced", 7, 7, 0, 2, 2), ("replaced", 9, 9, 0, 2, 2)]
    assert got[3] == [("inserted", None, 31, None, None, None)]
    assert got[4] == [("removed", i, None, None, None, None) for i in (40, 41, 42)]
    assert got[5] == [("inserted", None, 0, None, None, None), ("inserted", None, 60, None, None, None), ("inserted", None, 61, None, None, None), ("removed", 50, None, None, None, None)]
    assert got[6] == [("replaced", 0, 0, 0, 0, 1)] and got[7] == [] and got[8] == [("removed", 1, None, None, None, None)]


def test_located_edits_against_a_multiset_difference(spark):
    """On random texts of few distinct lines every edit is named, and nothing where the paragraphs agree."""
    rng = random.Random(5)
    pairs = []
    for _ in range(60):
        a = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 30))]
        b = a[:]
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(b) + 1)
            b = b[:k] + rng.choice([[], [rng.choice("abxyz")]]) + b[k + rng.randrange(2):]
        pairs.append(("\n".join(a), "\n".join(b)))
    for i, edits in located(spark, pairs).items():
        a, b = pairs[i][0].split("\n"), pairs[i][1].split("\n")
        assert bool(edits) == (a != b)
        if len(a) == len(b):
            assert {e[:3] for e in edits} == {("replaced", k, k) for k in range(len(a)) if a[k] != b[k]}
        else:
            from collections import Counter

            gone, new = Counter(a) - Counter(b), Counter(b) - Counter(a)
            assert Counter(a[e[1]] for e in edits if e[0] == "removed") == gone and Counter(b[e[2]] for e in edits if e[0] == "inserted") == new


def test_fingerprints_of_odd_rows(spark):
    rows = [(None, "alone"), (7, "same"), (7, "same"), (7, None), (2, "last")]
    got = fingerprint.fingerprints(docs_of(spark, rows)).collect()
    assert len(got) == 5
    loose = next(r for r in got if r.doc_id is None)
    assert loose.edited_sha256 == hashlib.sha256(b"alo").hexdigest()  # the first document's text is empty
    assert fingerprint.fingerprints(docs_of(spark, [])).count() == 0
    one = fingerprint.fingerprints(docs_of(spark, [(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def best_overlap(doc, item):
    """Most equal words of any diagonal stretch with a share of 0.8, by brute force."""
    a, b = decontaminate.tokens(doc), decontaminate.tokens(item)
    best = 0
    for d in range(-len(b) + 1, len(a)):
        lo, hi = max(0, d), min(len(a), d + len(b))
        eq = np.array([a[p] == b[p - d] for p in range(lo, hi)], int)
        sums = np.concatenate([[0], np.cumsum(eq)])
        for x in range(len(eq)):
            for y in range(x + 1, len(eq) + 1):
                n = sums[y] - sums[x]
                if n >= 0.8 * (y - x):
                    best = max(best, n)
    return best


def test_overlaps_tolerate_substitutions(spark):
    rng = random.Random(3)
    vocabulary = [f"v{k}" for k in range(500)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([12, 25, 40, 60, 7, 3])]
    docs, planted = [], set()
    for i in range(60):
        w = rng.choices(vocabulary, k=rng.randrange(5, 120))
        if i % 2:
            k = rng.randrange(5)
            p = items[k][1].split()
            for _ in range(0 if k in (0, 4) else len(p) // 12):
                p[rng.randrange(len(p))] = "swap"
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() + "," for x in p]
            planted.add((i, k))
        docs.append((i, " ".join(w)))
    got = decontaminate.find_overlaps(docs_of(spark, [*docs, (None, docs[1][1]), (99, None), (98, "")]), spark.createDataFrame([*items, (77, None), (78, "")], "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert planted <= pairs
    for i, k in pairs:
        if i is not None:
            assert best_overlap(docs[i][1], items[k][1]) >= min(decontaminate.MIN_EQUAL, len(items[k][1].split()))
    assert all(r.share >= decontaminate.MIN_SHARE and r.equal <= r.doc_end - r.doc_start for r in got)
    clean = {r.doc_id for r in decontaminate.keep_clean(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _ in pairs}


def test_test_side_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    items = spark.createDataFrame([(k, " ".join(f"i{k}w{j}" for j in range(15))) for k in range(6)], "item_id long, text string")
    docs = docs_of(spark, [(k, "start " + " ".join(f"i{k}w{j}" for j in range(15))) for k in range(6)])
    assert {(r.doc_id, r.item_id, r.doc_start, r.doc_end) for r in decontaminate.find_overlaps(docs, items).collect()} == {(k, k, 1, 16) for k in range(6)}
    assert decontaminate.keep_clean(docs, items).count() == 0
    assert decontaminate.find_overlaps(docs, items.where("false")).count() == 0


def mixed(spark, n=4000):
    rng = random.Random(5)
    rows = [(i, "word " * rng.randrange(1, 60), "en" if rng.random() < 0.8 else None, "hot" if rng.random() < 0.5 else f"s{rng.randrange(4)}", "w", 1.0) for i in range(n)]
    rows += [(n, None, "en", "hot", "w", 1.0), (n + 1, "", None, None, "w", 1.0), (None, "a b", "en", "hot", "w", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string, p double")


def test_raked_weights_meet_their_targets(spark):
    docs = mixed(spark)
    want = {"hot": 0.2, "s0": 0.3, "s1": 0.2, "s2": 0.2, "s3": 0.1}
    targets = {"source": spark.createDataFrame(list(want.items()), "category string, share double")}
    got = mixing.mix(docs, 0.3, targets).toPandas()
    assert len(got) == 4003 and got.row[0].keys() if isinstance(got.row[0], dict) else True
    got["mass"] = got.n * got.weight.fillna(0)
    share = got.groupby("source").mass.sum() / got.mass.sum()
    assert all(share[s] == pytest.approx(v, abs=1e-6) for s, v in want.items())
    assert (got.n * got.p).sum() / got.n.sum() == pytest.approx(0.3, abs=1e-6)
    assert got.n[got.kept].sum() / got.n.sum() == pytest.approx(0.3, abs=0.03)
    assert got.kept[got.n == 0].all()


def test_sample_keeps_columns_and_repeats(spark):
    docs = mixed(spark, 300)
    a, b = (sorted(map(str, mixing.sample(d, 0.5).collect())) for d in (docs, docs.repartition(7)))
    assert a == b and mixing.sample(docs).columns == docs.columns
    assert mixing.sample(docs, 2.0).count() == 303 and mixing.sample(docs.where("false")).count() == 0


def test_layout():
    html = """<!doctype html><html><head><title>no</title><style>x</style><body><h1>Head &amp; <b>bold</b></h1>intro   text<p>one<p>two<br>line<ul><li>a<li>b<ol start=3><li>x</li>
<li>y</ol><li>c</ul><table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td>Fig<td>12<td>late</table><div hidden>nope</div><div style="display:NONE">nope</div><pre>  keep
    this</pre><blockquote>quoted<p>more</blockquote><script>var a="<p>";</script>tail<!-- c --> end <a href='x>y'>link</a> 3 < 4 <b"""
    want = """Head & bold\n\nintro text\n\none\n\ntwo\nline\n\n- a\n- b\n  3. x\n  4. y\n- c\n\nName       Qty\nApple pie  3\nFig        12   late\n\n  keep\n    this\n\n  quoted\n\n  more\n\ntail end link 3 < 4"""
    assert htmltext.visible_text(html) == want


@pytest.mark.parametrize(("html", "want"), [
    ("", ""), ("<", "<"), ("<!--", ""), ("<p", ""), ("</>", ""), ("a<br><br>b", "a\n\nb"), ("<title>t</title>b", "b"), ("<td>loose", "loose"), ("<textarea>seen</textarea>", "seen"),
    ("<p></div>t</p></table>", "t"), ("<svg><title>t</title><text>a</text><text>b</text><p>no</svg>yes", "a b\n\nnoyes"), ("<div>" * 3000 + "x", "x"), ("<ul><ul><li>q</ul></ul>", "- q"), ("<head><script>x</script> hi", "hi"), ("<a b='c", ""), ("x<script>y", "x"),
])
def test_broken_markup(html, want):
    assert htmltext.visible_text(html) == want


def test_extract(spark):
    rows = [(1, "<p>a", "t"), (None, None, "t"), (2, "", "t"), (2, "<p>" + "w " * 100_000, "t")]
    got = sorted(((r.page_id, r.n_chars) for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()), key=str)
    assert got == sorted([(1, 1), (None, 0), (2, 0), (2, 199_999)], key=str)
    assert htmltext.extract(spark.createDataFrame([], "page_id long, html string, text string")).count() == 0


def test_pages_against_a_plain_reader(spark):
    """All words a plain parser sees in the body, in order."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.off, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("title", "style", "script")

        def handle_endtag(self, tag):
            self.off -= tag in ("title", "style", "script")

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in htmltext.extract(pages).collect():
        p = Plain()
        p.feed(source[r.page_id] if "</html>" in source[r.page_id] else "")
        if p.out:
            assert "".join(r.text.replace("- ", "").split()) == "".join("".join(p.out).replace("- ", "").split())


@pytest.mark.parametrize(("parts", "found"), [
    ((20, -12, 20), [(0, 20), (32, 52)]), ((20, -15, 25), [(0, 20), (35, 60)]), ((20, -4, 12), [(0, 36)]), ((9, -1, 3), [(0, 13)]), ((9, -9, 30), [(0, 48)]), ((9, -12, 30), [(21, 51)]), ((30,), [(0, 30)]),
])
def test_halves_of_a_rewritten_item(parts, found):
    """Copying more of an item does not hide what is copied. Parts: equal words, or different ones."""
    item = [f"i{k}" for k in range(sum(map(abs, parts)))]
    doc, at = [], 0
    for n in parts:
        doc += item[at : at + n] if n > 0 else [f"d{at + k}" for k in range(-n)]
        at += abs(n)
    block = decontaminate.Block([(1, " ".join(item))])
    got = decontaminate.overlaps(block, decontaminate.Lexicon().hashes(decontaminate.tokens("a b c " + " ".join(doc) + " d e f")))
    assert [(o[3], o[4]) for o in got] == found and all(o[6] >= decontaminate.MIN_SHARE for o in got)


def test_every_pattern_of_substitutions_is_hit():
    """Fewest differences that leave no mask whole, by enumeration of the last words: always over a fifth."""
    span = max(map(len, decontaminate.SEEDS))
    masks = [(int(m, 2), len(m)) for m in decontaminate.SEEDS]
    fewest = {0: 0}  # last words (1: equal) -> fewest differences
    for n in range(1, 201):
        then = {}
        for last, different in fewest.items():
            for equal in (0, 1):
                now = (last << 1 | equal) & ((1 << span) - 1)
                if not any(n >= size and now & mask == mask for mask, size in masks):
                    then[now] = min(then.get(now, n), different + 1 - equal)
        fewest = then
        assert n < 12 or min(fewest.values()) > n * (1 - decontaminate.MIN_SHARE) + 1e-9


@pytest.mark.parametrize(("length", "changed"), [(12, 2), (14, 2), (16, 3), (20, 4), (25, 5)])
def test_short_items_with_changed_words(length, changed):
    rng = random.Random(length)
    item = [f"i{k}" for k in range(length)]
    block, lexicon = decontaminate.Block([(1, " ".join(item))]), decontaminate.Lexicon()
    for _ in range(300):
        swap = set(rng.sample(range(length), changed))
        doc = "a b c " + " ".join("swap" if k in swap else w for k, w in enumerate(item)) + " d e f"
        got = decontaminate.overlaps(block, lexicon.hashes(decontaminate.tokens(doc)))
        assert max(o[5] for o in got) == length - changed


@pytest.mark.parametrize("html, want", [
    ("<p>Pick <select><option>one<option selected>two</select> now", "Pick\none\ntwo\nnow"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>", "x=2"),
    ("<map name=m><area href=x>see <a>here</a></map>", "see here"),
    ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b  c\n   d  e\nf  g"),
    ("<table><tr><td rowspan=0>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td><p>one<p>two<ul><li>x<li>y</ul><td>side</table>", "one  side\n\ntwo\n\n- x\n- y"),
    ("<table><tr><td colspan=2000>wide<td>z<tr><td>p<td>q</table>", "wide     z\np     q"),
    ("<table><tr><td>l<td><table><tr><td>1<td>2<tr><td>3<td>4</table><td>r</table>", "l  1  2  r\n   3  4"),
])
def test_layout_by_hand(html, want):
    assert htmltext.visible_text(html) == want
