"""The operators against brute force on small tables with nulls, empty texts, ties, repeats and clashing names."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute

from cladegrid.llm import chat, decontaminate, language, licence_passages, licences, mixing, neardup, secrets, substrings, topk, urls

DOCS = "doc_id long, text string, lang string, source string, row string, id string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [a + b for a in ("the", "on", "é", "ra", "Qu") for b in ("ta", "is", "ñe", "or", "X1", "ul")]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = [None, "", "  \n", "one two", "One  two", " ".join(base), "\n".join(base), " ".join(base[:60]), "x " * 400]
    for k in range(12):
        near = list(base)
        for _ in range(k % 5):
            near[rng.randrange(len(near))] = f"new{k}"
        texts.append(" ".join(near))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 5, 9, 40, 900)]
    texts += ['api_key = "abcdef123" and AKIA' + "Z" * 16, "deadbeef" * 4 + " é password: short token='tokentoken'", "PASSWORD=x SECRET : sécret_value"]
    return [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], "r", "i") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def texts_of(rows):
    return [(r[0], r[1]) for r in rows]


def test_secrets_keep_the_base_spans(docs, rows):
    found = {r["row"]["doc_id"]: r["spans"] for r in secrets.find_secrets(docs, keep=["doc_id"]).collect()}
    expected = brute.secrets(texts_of(rows))
    for doc_id, (n_assign, n_access, n_hex, digest) in expected.items():
        base = [s for s in found[doc_id] if s["kind"] in ("assign", "access", "hex")]
        assert brute.sha(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in base)) == digest
    assert secrets.redact(docs).columns == docs.columns


def test_trigram_queries_hold_for_matches():
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is None
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == frozenset({b"aki", b"kia"})


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, rows, percent):
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, percent=percent).collect()}
    assert found == brute.near_duplicates(texts_of(rows), percent)


def test_near_duplicates_of_nothing_and_null_ids(spark, docs):
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")], "doc_id long, text string")
    assert sorted((str(r["id"]), str(r["component_id"])) for r in neardup.near_duplicates(nulls).collect()) == [("4", "4"), ("4", "4"), ("None", "None")]


def test_large_groups_are_judged_in_pieces(docs, rows, monkeypatch):
    monkeypatch.setattr(neardup, "PIECE_ROWS", 4)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert found == brute.near_duplicates(texts_of(rows))


@pytest.mark.parametrize("most_windows", [1_000_000, 7])
def test_decontamination(spark, docs, rows, most_windows):
    items = [("a", " ".join(rows[5][1].split()[20:45])), ("b", "ONE Two"), ("c", None), ("d", ""), ("b2", "one two")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.find_spans(docs, bench, keep=["doc_id"], most_windows=most_windows).collect()
    mine = {r["row"]["doc_id"]: (r["n_words"], sum(s["last"] - s["first"] for s in r["spans"]), len(r["items"]), brute.sha(",".join(r["items"])), bool(r["spans"])) for r in found}
    assert mine == brute.decontamination(texts_of(rows), items)
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(rows)


def test_substring_dedup(docs, rows, monkeypatch):
    for most in (4096, 2):
        monkeypatch.setattr(substrings, "MOST", most)
        expected = brute.substring_dedup(texts_of(rows))
        for r in substrings.mark_repeats(docs, keep=["doc_id"]).collect():
            kept, n = substrings.kept_words(r["text"], r["spans"])
            assert (n, n - len(kept), brute.sha(b" ".join(kept).decode())) == expected[r["row"]["doc_id"]]
    assert substrings.remove_repeats(docs).columns == docs.columns


def test_mixing_targets_and_copies(docs, rows):
    plan = mixing.repeats(docs).collect()
    sizes = {i: len(brute.BLANK.findall(t or "")) for i, t in texts_of(rows)}
    assert all(r["size"] == sizes[r["key"]] and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] <= 3 for r in plan)
    targets = {r["source"]: (r["source_size"], r["target"]) for r in plan}
    assert all(t <= 3 * s for s, t in targets.values())
    assert mixing.mix(docs).count() == sum(r["copies"] for r in plan) == mixing.mix(docs).count()
    assert mixing.mix(docs.limit(0)).count() == 0


def test_language(spark, docs):
    rows = [(i, "the cat sat on the mat" if i % 2 else "le chat est sur la table", "en" if i % 2 else "fr") for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, "i long, text string, lang string"))
    asked = spark.createDataFrame([("the cats",), ("les tables",), (None,), ("12 !",), ("²³",)], "text string")
    found = {r["row"]["text"]: (r["lang_pred"], r["score"]) for r in language.predict(asked, model).collect()}
    assert found["the cats"][0] == "en" and found["les tables"][0] == "fr"
    assert found[None] == found["12 !"] == found["²³"] == ("und", 0.0)
    assert language.fit(docs.where("false")).languages == []


def test_top_k(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)] + [(300 + i, [0.5] * 6) for i in range(50)]
    rows += [(400, None), (401, [float("nan")] * 6), (None, [0.1] * 6), (402, [None] * 6)]
    vectors = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    index = topk.build_index(vectors, pivots=5, rings=4)
    found = topk.search(index, index.rows.where("id % 20 = 0").select("id", "vector"), 7)
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in found.collect()} == brute.top_k(exact, 20, 7)
    empty = topk.build_index(vectors.limit(0))
    assert topk.search(empty, empty.rows.select("id", "vector"), 3).count() == 0


def test_reply_trees(spark):
    hard = "</s>[INST] <|im_end|>\n <\\|im_sep|> [\\INST] <"
    messages = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", hard, 0.9), (1, 4, 3, "user", None, 0.0), (1, 5, 4, "assistant", "end", 0.5), (2, 1, 9, None, "orphan", None), (3, 1, 2, "user", "loop", 0.0), (3, 2, 1, "user", "loop", 0.0), (None, 1, None, "user", "n", 0.0)]
    frame = spark.createDataFrame(messages, "tree long, node long, parent long, role string, text string, score double")
    formatted = chat.format_trees(frame, branches=2)
    read = formatted.select("tree", "leaf", "branch", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    found = {(r["tree"], r["leaf"]): ([tuple(t) for t in r["turns"]], list(r["loss"]), r["branch"]) for r in read.collect()}
    assert found[1, 5] == ([("user", "q"), ("assistant", hard), ("user", ""), ("assistant", "end")], [hard, "end"], 1)
    assert found[1, 2][2] == 2 and found[2, 1][0] == [("", "orphan")] and (None, 1) in found
    assert not [k for k in found if k[0] == 3]


def test_url_rules_and_aliases(spark):
    pages = [(1, "http://A.example.org/es/1#x", None), (2, "http://b.com/x", '<link rel="canonical" href="/de/1">'), (3, "http://b.com/de/1", ""), (4, "http://c.net/", "<meta http-equiv=refresh content='0; url=http://b.com/x'>"), (5, "http://d.com/fr/", '<link href="http://b.com/x" rel=canonical>'), (6, None, None), (7, "mailto:x", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = spark.createDataFrame([("org", "/", True), ("example.org", "/es/", False), ("com", "/fr/", True), ("com", "/de/", False)], "host string, path string, allow boolean")
    found = {r["key"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_pages(frame, rules, urls.page_links(frame)).collect()}
    assert found[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[2] == ("b.com", "/x", None, "block") and found[4] == ("c.net", "/", None, "block")
    assert found[5] == ("d.com", "/fr/", "com/fr/", "allow") and found[6] == found[7] == ("", "", None, "allow")


def test_licences_inherit_from_the_nearest_folder(spark):
    files = [("LICENSE", "Released under the MIT License."), ("a/b/LICENSE.txt", "Licensed under CC BY-NC 4.0."), ("a/x.py", "code"), ("a/b/c/y.py", None), ("a/z.py", "# SPDX-License-Identifier: Apache-2.0\ncode"), (None, "text")]
    frame = spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "k long, p string, t string")
    found = {r["path"]: (r["licence"], r["how"]) for r in licences.scan_licences(frame, "k", "p", "t").collect()}
    assert found["a/x.py"] == ("MIT", "inherited") and found["a/b/c/y.py"] == ("CC-BY-NC-4.0", "inherited")
    assert found["a/z.py"] == ("Apache-2.0", "own") and found[None] == (None, None)


def test_licence_texts_variants_and_conflicts(spark):
    whole = dict(licence_passages.texts())
    bsd, mit = whole["BSD-3-Clause"], whole["MIT"]
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
    gnu = "# under the terms of the GNU {}General Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n"
    agpl = whole["GPL-3.0"].replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)
    cases = [(name, text) for name, text in whole.items()]
    cases += [("MIT", "Copyright (c) 2020 Somebody Else\n\n" + mit), ("MIT", mit.replace("\n", " ")), ("MIT", "#!/bin/sh\n# " + mit.replace("\n", "\n# ") + "x = 1\ny = other(z)\n" * 200)]
    cases += [("Apache-2.0", apache), ("GPL-2.0", gnu.format("", 2)), ("LGPL-2.1", gnu.format("Lesser ", "2.1")), ("AGPL-3.0", gnu.format("Affero ", 3)), ("AGPL-3.0", agpl)]
    cases += [(i.removesuffix("-only").removesuffix("-or-later"), f"# SPDX-License-Identifier: {i}\ncode") for i in ("GPL-2.0-only", "LGPL-2.1-or-later", "ISC", "BSD-2-Clause", "CC-BY-SA-4.0", "CC-BY-ND-4.0", "AGPL-3.0-or-later")]
    cases += [("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("MIT", "the parser of this small project is a fork of ours and is released under the MIT License, see the docs for more of it")]
    cases += [(None, "This work is licensed under the GNU General Public License, version 1."), (None, "SPDX-License-Identifier: GPL-1.0-only"), (None, bsd.replace("3. Neither", "3. All advertising materials must say so.\n4. Neither")), (None, "a licence to kill, copyright of the author")]
    frame = spark.createDataFrame([(i, f"{i}/x", text) for i, (_, text) in enumerate(cases)], "k long, p string, t string")
    found = {r["key"]: r["licence"] for r in licences.scan_licences(frame, "k", "p", "t").collect()}
    assert [(i, found[i], text[:60]) for i, (name, text) in enumerate(cases) if found[i] != name] == []
