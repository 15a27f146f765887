"""Prefix trie, tokenizer alignment and personal data against brute force, with nulls, ties, repeats and empty tables."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute_round3 as brute

from cladegrid.llm import alignment, language, personal, trie

TURNS = "conv_id long, turn long, role string, text string, key string, pos string"


def conversations(rng):
    out = []
    for c in [*range(0, 45), 60, 61, 1000, -3, -20]:
        for t in range(rng.choice([0, 1, 2, 5, 9, 17, 40])):
            text = rng.choice(["hi", "hi there", None, "", "  a  b "]) if t < 3 or c % 3 else f"same {t}"
            out.append((c, rng.choice([t, t, t, None]) if c % 5 == 0 else t, rng.choice(["user", None, "assistant"]) if t > 6 else "user", text, "k", "p"))
    for c in (200, 201, 205):  # copies that end together, longer than a block
        out += [(c, t, "user", f"copied {t} turn", "k", "p") for t in range(19)]
    out += [(7, 0, "user", "hi", "k", "p")] * 2 + [(None, 0, "user", "no conversation", "k", "p")]
    return out


@pytest.mark.parametrize("block", [1, 4])
def test_prefix_trie(spark, block):
    rows = conversations(random.Random(block))
    numbered = trie.number_turns(spark.createDataFrame(rows, TURNS))
    turns, convs = trie.share_openings(numbered, 20, 4)
    found = [tuple(r) for r in trie.prefix_trie(turns, convs, block).collect()]
    assert len(set(found)) == len(found)
    assert set(found) == brute.trie(brute.rebuilt([r[:4] for r in rows]))


def test_prefix_trie_of_no_rows_and_of_turnless_conversations(spark):
    none = trie.number_turns(spark.createDataFrame([], TURNS))
    assert trie.prefix_trie(*trie.share_openings(none, 20, 4)).collect() == []
    only = spark.createDataFrame([(3,), (12,)], "conv long")
    root = trie.prefix_trie(none, only).collect()
    assert [tuple(r) for r in root] == [(3, 0, None, 2, 0, 1, 0, brute.sha("3,12"))]


def texts():
    rng = random.Random(9)
    pieces = ["the ", "café", "\n\n", "  ", "日本語", "𝔘", "\x00", "don't", "12345", "!!", "ß", "a" * 70, "<s>", "<|endoftext|>", "é"]
    out = [None, "", " ", "▁ cannot be spelled", "same text", "same text", "x" * 4000, "ab" * 3000, " ".join(["the cat"] * 5000), "<0x41> </s> <unk>"]
    return out + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(40)]


@pytest.mark.parametrize("chunk", [1, alignment.CHUNK_BYTES])
def test_alignment(spark, monkeypatch, chunk):
    given = texts()
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x", i) for i, t in enumerate(given)], "doc_id long, text string, row string, place long").coalesce(2)
    found = {r["row"]["place"]: tuple(r)[1:] for r in alignment.align(docs, chunk_bytes=chunk).collect()}
    assert [found[i] for i in range(len(given))] == brute.alignment(given, alignment.A_FILE, alignment.B_FILE)
    assert alignment.align(docs.limit(0)).collect() == []


def test_cuts_at_any_distance_from_the_middle():
    rng = np.random.default_rng(4)
    for size, shared in ((1, 1), (5, 1), (3000, 2), (3000, 40), (3000, 2900)):
        every = np.cumsum(rng.integers(1, 5, 2 * size))
        a, b = np.sort(rng.choice(every[:-1], size, replace=False)), np.sort(rng.choice(every[:-1], size, replace=False))
        both = np.sort(rng.choice(every[:-1], shared - 1, replace=False))
        a, b = (np.unique(np.concatenate([x, both, every[-1:]])) for x in (a, b))
        if size == 3000 and shared < 100:  # only the chosen ends are common
            b = np.unique(np.concatenate([b[~np.isin(b, a)], both, every[-1:]]))
        assert np.array_equal(a[alignment.common_cuts(a, b)], np.intersect1d(a, b))


def test_wide_groups_are_linked_through_their_different_ids(monkeypatch):
    with open(alignment.A_FILE, "rb") as a, open(alignment.B_FILE, "rb") as b:
        tools = alignment._tokenizers(a.read(), b.read())
    given = [t for t in texts() if t]
    plain = alignment._Aligned(given, *tools)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    wide = alignment._Aligned(given, *tools)
    for field in ("codes", "times", "sizes", "n_links"):
        assert np.array_equal(getattr(plain, field), getattr(wide, field))


def test_tokenizers_give_the_ids_of_their_files():
    with open(alignment.A_FILE, "rb") as f:
        ranked = alignment.ByteTokenizer(f.read())
    rng = random.Random(2)
    given = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0xD800), rng.randrange(0xE000, 0x30000), 10, 32])) for _ in range(50)) for _ in range(300)]
    for text, ids in zip(given, ranked(given)):
        expected = brute.tokens_of(text, alignment.A_FILE, alignment.B_FILE)
        assert expected is None or ids.tolist() == expected[0][0]


def test_base_patterns():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice("ab1290.@+- ()\n%_é4") for _ in range(rng.randrange(60)))
        assert [(personal.KINDS[k], a, b) for k, a, b in personal.base_spans(text)] == brute.personal(text)
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.1.1 " * 50_000):  # in proportion to the text
        personal.base_spans(text)


def test_gradient():
    tagger, rng = personal.Tagger(3, 1, float), np.random.default_rng(0)
    ids, labels = rng.integers(0, personal.CHARACTERS, (2, 7)), np.array([[0, 1, 2, 2, 0, 3, 4], [5, 6, 6, 0, 0, 7, 8]])
    grad = tagger.loss(ids, labels)[1]
    for name, values in tagger.p.items():
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in values.shape)
            at = (at[0], ids[0, at[1] % 7], at[2]) if name == "x" else at
            sides = []
            for step in (1e-5, -2e-5):
                values[at] += step
                sides.append(tagger.loss(ids, labels)[0])
            values[at] += 1e-5
            assert abs((sides[0] - sides[1]) / 2e-5 - grad[name][at]) < 1e-6


def _personal_rows(rng, n):
    words = ["the", "on", "paid", "é", "version", "in", "2019", "room", "12", "x"]
    makers = (
        lambda: f"{rng.choice(['ann', 'j.doe', 'info7'])}{rng.randrange(99)}@{rng.choice(['mail', 'post3'])}.example.{rng.choice(['com', 'org'])}",
        lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        lambda: _card(rng),
        lambda: f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}-{rng.randrange(100, 999)}",
    )
    for i in range(n):
        left, right = (" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(2))
        yield i, f"{left} {rng.choice(makers)() if i % 3 else ''} {right}"


def _card(rng):
    body = "".join(str(rng.randrange(10)) for _ in range(15))
    digits = next(body + str(d) for d in range(10) if personal.luhn(body + str(d)))
    return rng.choice(["", " ", "-"]).join(digits[i : i + 4] for i in range(0, 16, 4))


def test_personal_data(spark):
    rng = random.Random(8)
    rows = list(_personal_rows(rng, 700))
    learned = spark.createDataFrame(rows[:500], "doc_id long, text string")
    tagger = personal.fit(learned, per_kind=120, steps=500)
    # held-out spans, found by the network alone
    held = [t for _, t in rows[500:]]
    exact, alone = [set(personal.base_spans(t)) for t in held], [set(s) for s in personal.tag(held, tagger)]
    right = sum(len(a & b) for a, b in zip(exact, alone))
    assert right >= 0.8 * sum(map(len, exact)) and right >= 0.8 * sum(map(len, alone))

    odd = [(None, None), (1, ""), (1, "mail a@b.co"), (1, "mail a@b.co"), (2, " word" * 30_000 + " x9@mail.example.com"), (3, "pay 4111.1111.1111.1111 now")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in odd], "doc_id long, text string, row string, spans string")
    found = personal.find_personal(docs, tagger).collect()
    assert len(found) == len(odd)
    for r in found:
        text = r["row"]["text"]
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        assert base == brute.personal(text) and set(base) <= set(spans)
        order = [(personal.KINDS.index(k), a) for k, a, _ in spans]
        assert order == sorted(order)
        for k, a, b in set(spans) - set(base):
            assert personal.passes(personal.KINDS.index(k), text[a:b])
    assert personal.fit(docs.where("text is null")) is None
    assert [r["spans"] for r in personal.find_personal(docs.limit(1), None).collect()] == [[]]
    assert personal.find_personal(docs.limit(0), tagger).collect() == []


def test_sampled_windows_are_bounded_and_repeat(spark):
    rows = list(_personal_rows(random.Random(3), 400))
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    found = [sorted(tuple(r) for r in personal.sample_windows(docs.repartition(n), per_kind=10).collect()) for n in (2, 7)]
    assert found[0] == found[1]
    kinds = [r[0] for r in found[0]]
    assert {kinds.count(k) for k in range(-1, 4)} == {10}


def test_language_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "zzzqqq unseenlike wörter", None), (-4, "x² 12 ¾", "fr"), (-5, "der der der la the", None)], docs.schema)
    rows = docs.unionByName(odd)
    model = language.fit(rows.where("doc_id % 5 <> 0"))
    found = {r["row"]["doc_id"]: (r.lang_pred, r.score) for r in language.predict(rows, model, keep=["doc_id"]).collect()}
    listed = [tuple(r) for r in rows.collect()]
    expected = brute.languages([(lang, text) for i, text, lang in listed if int(i) % 5 or i < 0 and i % -5], [text for _, text, _ in listed])
    for (i, _, _), (lang, score) in zip(listed, expected):
        assert found[i][0] == lang and found[i][1] == pytest.approx(score, rel=1e-9, abs=1e-12)
