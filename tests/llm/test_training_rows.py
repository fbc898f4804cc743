"""Fill-in-middle, importance resampling and chat formatting against plain versions, with the cases that rows bring."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm import chat, infill, resampling

DOCS = "doc_id long, text string, n string, form string, part string, row long, score string, able boolean"


def docs_of(spark, rows):
    """Other columns have the names that the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z", 7, "s", None) for i, t in rows], DOCS)


# fill-in-middle


def plain_infill(doc_id, text):
    text = text or ""
    unit = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(unit), "plain", None, None, text
    a, b = sorted((h[0] % (len(unit) + 1), h[1] % (len(unit) + 1)))
    p, m, s = "".join(unit[:a]), "".join(unit[a:b]), "".join(unit[b:])
    spm = h[3] % 100 < 80
    return len(unit), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, " ", "\t\n", "one", " one", "one ", "a  b\nc", "a b \u0085c", "x₪\U0001f600 \U0001f600\U0001f600 y", "has <P> mark", "<S><M>", "< P> <", "<<P", "$1 \\ $2 {3}", "a\r\nb\x0bc\x0cd", "ends <S", "\x1fa \x00b", "end\n"]


def test_fill_in_middle_equals_a_plain_version(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "null id " * 5)] * 3 + [(5, "twice the id"), (5, "twice the id")]
    got = infill.infill(docs_of(spark, rows)).withColumn("restored", infill.restore(infill.F.col("output"), infill.F.col("form"))).collect()
    assert len(got) == len(rows)
    want = sorted(((i, t or "", *plain_infill(i, t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text, r.n, r.form, None if r.prefix is None else len(r.prefix), None if r.middle is None else len(r.middle), r.output) for r in got), key=str) == want
    assert all(r.restored == r.text for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_very_long_texts_needs_no_stack(spark):
    long = [(i, f"w{i} " * 700_000) for i in range(3)] + [(i, "x" * 3_000_000) for i in range(3, 6)] + [(i, " " * 3_000_000) for i in range(6, 9)]
    got = {r.doc_id: r for r in infill.digests(docs_of(spark, long)).collect()}
    for i, t in long:
        n, form, p, m, out = plain_infill(i, t)
        assert (got[i].n, got[i].form, got[i].prefix_chars, got[i].middle_chars) == (n, form, p, m)
        assert got[i].output_sha256 == hashlib.sha256(out.encode()).hexdigest() and got[i].restored_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert {got[i].form for i, _ in long} != {"plain"}


def test_fill_in_middle_of_an_empty_table(spark):
    assert infill.digests(docs_of(spark, [])).count() == 0


# importance resampling


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_resample(docs, target, width=1, buckets=10_000, per_cent=10, least=20):
    grams = lambda t: [" ".join(w[i : i + n]) for w in [words_of(t)] for n in range(1, width + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, x in docs:
        for g in grams(x):
            s[bucket(g)] += 1
    for x in target:
        for g in grams(x):
            t[bucket(g)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        g = grams(x)
        weight = sum(gain[bucket(f)] for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * per_cent // 100]
    return sorted([(*r[:4], k) for k, r in enumerate(drawn, 1)] + [(*r[:4], None) for r in able[len(drawn) :] + [r for r in rows if not r[4]]], key=str)


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(r.choice(["Alpha", "beta,", "gamma.", "DELTA9", "été", "Ünter", "漢字", "a-b", "x" * 40, "x" * 70 + "y", "x" * 70 + "z", "long" * 9]) for _ in range(words))


@pytest.mark.parametrize("width,buckets,per_cent", [(1, 10_000, 10), (3, 64, 35), (1, 10_000, 100), (2, 10, 0)])
def test_resampling_equals_a_plain_version(spark, width, buckets, per_cent):
    docs = [(i, prose(i, 3 * i)) for i in range(60)] + [(100, None), (101, ""), (102, "!! --"), (None, prose(9, 30)), (None, prose(9, 30))] + [(7, prose(7, 40))] * 25
    target = [prose(i, 25) for i in range(900, 906)] + [None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs_of(spark, docs), bench, width=width, buckets=buckets, per_cent=per_cent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(docs, target, width, buckets, per_cent)


def test_resampling_of_texts_past_a_block_and_a_group(spark, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK", 50)
    monkeypatch.setattr(resampling, "GROUP_BYTES", 4000)
    docs = [(i, prose(i, n)) for i, n in enumerate([0, 1, 2000, 3, 5000, 40, 40, 40])]
    rows = [(t.encode(), i) for i, t in docs]
    got = [0] * len(docs)
    for group in resampling.groups([resampling.pa.RecordBatch.from_pydict({"t": [r[0] for r in rows], "i": [r[1] for r in rows]})], 2):
        for data, start, size, text in resampling.features([r[0] for r in group], 2):
            assert len(start) <= 50
            for s, n, k in zip(start.tolist(), size.tolist(), text.tolist(), strict=True):
                assert data[s : s + n].tobytes().decode()[0] != " "
                got[group[k][1]] += 1
    assert got == [max(0, 2 * len(words_of(t)) - 1) for _, t in docs]


def test_resampling_of_empty_tables(spark):
    none, bench = docs_of(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(none, bench).count() == 0
    assert [tuple(r) for r in resampling.resample(docs_of(spark, [(1, prose(1, 30))]), bench, per_cent=100).collect()] == plain_resample([(1, prose(1, 30))], [], per_cent=100)


def test_keys_are_those_of_xxhash64():
    r = np.random.default_rng(5)
    data = r.integers(0, 256, 20_000).astype(np.uint8)
    size = np.concatenate([np.arange(0, 80), r.integers(0, 40, 500)])
    start = r.integers(0, 19_000, len(size))
    assert resampling.xxhash64(data, start, size).tolist() == [xxhash.xxh64_intdigest(data[s : s + n].tobytes()) for s, n in zip(start, size, strict=True)]


def test_equal_keys_of_different_bytes_share_no_slot(monkeypatch):
    monkeypatch.setattr(resampling, "xxhash64", lambda data, start, size: np.full(len(start), 3, np.uint64))
    words = [b"one", b"two", b"one", b"three", b"two", b"t" * 90 + b"a", b"t" * 90 + b"b", b"t" * 90 + b"a"]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    table = resampling.Interner(data, start, size, 10_000)
    assert [words.index(w) for w in words] == [table.slot.tolist().index(s) for s in table.slot.tolist()]
    assert [table.bucket[s] for s in table.slot] == [zlib.crc32(w) % 10_000 for w in words] and table.count[table.used].sum() == len(words)


# chat formatting

TRICKY = ["", "</s>", "[INST] hi [/INST]", "<\\s>", "<\\\\s>", "</\\s>", "[ANS] x </s>", "<<SYS>>\n", "<<<SYS>>>", "<\n</s>", "[[INST]]", "\\", "<", "/s>", "[/INS", "a\\[INST\\]", "[ROLE] a [/ROLE] "]


@given(st.lists(st.sampled_from(["<", "/", "s", ">", "[", "]", "\\", "INST", "SYS", "ROLE", "ANS", " ", "\n", "<s>", "</s>", "[INST]", "é"]), max_size=20), st.sampled_from(["system", "user", "assistant", "", "tool", "<s>", "[/ROLE] "]), st.sampled_from(["", "<s>"]))
@settings(max_examples=400, deadline=None)
def test_a_formatted_turn_reads_back(parts, role, mark):
    text, t = "".join(parts), chat.INSTRUCT
    escaped = t.escape(text)
    assert t.unescape(escaped) == text and not any(c in escaped for c in t.controls)
    assert t.parse("".join(s for s, _ in t.segments(mark, role, text))) == (role, text)


def test_templates_whose_control_strings_overlap_are_refused():
    for controls in (("<s>", "a<s>b"), ("<s>", "s>x"), ("<a<", "[b]"), ("a",), ("a\\b",)):
        with pytest.raises(ValueError, match="control string"):
            chat.Template(controls, {}, chat.Marks("<{role}>", ""), {}, frozenset())


def test_chats_of_every_kind_read_back(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate(zip(["system", "user", "assistant"] * 6, TRICKY, strict=False))]
    rows += [(2, 0, "assistant", "first"), (2, 1, "assistant", "again"), (2, 2, None, None), (2, 3, "tool", "</s>"), (2, None, "user", "null turn")]
    rows += [(3, 5, "user", "b"), (3, 5, "user", "a"), (3, 5, "user", "a"), (None, 0, "user", "nobody"), (None, 1, "assistant", "\U0001f600é"), (4, 0, "user", "x" * 500_000), (4, 1, "assistant", "[INST]" * 100_000)]
    rows += [(6, k, "user" if k % 2 == 0 else "assistant", f"turn {k}") for k in range(5000)]
    table = spark.createDataFrame([(*r, "clash", True) for r in rows], "conv_id long, turn long, role string, text string, segments string, violation boolean")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.with_check(table))).collect()}
    rows += [(-1, 0, "user", chat.CHECK_TEXT), (-1, 1, "assistant", chat.CHECK_TEXT)]
    assert set(got) == {r[0] for r in rows}
    for i, r in got.items():
        turns = sorted(((-1 if t[1] is None else t[1], t[2] or "", t[3] or "") for t in rows if t[0] == i))
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert {i: (r.violations, r.complete) for i, r in got.items()} == {-1: (0, True), 1: (5, False), 2: (3, True), 3: (2, False), None: (0, True), 4: (0, True), 6: (0, True)}
    assert got[-1].formatted_chars == len("<s>[INST]  [/INST][ANS]  </s>") + 2 * (len(chat.CHECK_TEXT) + 3)


def test_segments_carry_the_loss_mask(spark):
    table = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a </s>"), (1, 2, "user", "r")], "conv_id long, turn long, role string, text string")
    segments = [tuple(s) for r in chat.format_chats(table).collect() for s in r.segments]
    assert "".join(t for t, _ in segments) == "<s>[INST] q [/INST][ANS] a <\\/s> </s><s>[INST] r [/INST]"
    assert [t for t, loss in segments if loss] == ["a <\\/s>"]


def test_chats_of_an_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(table)).count() == 0
