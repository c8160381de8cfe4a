"""Every operator against brute force on whole small tables, and on rows chosen to break it."""

import hashlib
import os
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("postings.llm")
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from postings.llm import (
    fingerprints, jaccard_join, labelled, licence_scan, mixing, piece_lattice, quality_classifier, quality_rules, queries,
    suffix_dedup, token_codes, toxicity, workers,
)
from postings.llm.components import components
from postings.llm.text import words as numbered_words
from postings.sources.warehouse import stored
from verification.compare import connect, normal

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t string, size string, node string, _head string, kept string"

LONG = " ".join(f"word{k % 977} {k}" for k in range(20_000))
PASSAGE = " ".join(f"shared{k}" for k in range(60))
ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 4), (4, "one two", None, "a", 7),
    (5, "one two", "en", "b", 7), (6, LONG, "en", "a", 1), (7, LONG + " end", "en", "a", 1), (8, f"x {PASSAGE} y", "de", "b", 2),
    (9, f"other {PASSAGE} text. Licensed under CC BY-NC 4.0.", "de", "b", 2), (10, "a▁b <|endoftext|> é 日本 \x00 ퟿", "de", "", 3),
    (11, "tab\tin\r\nlines\n\nand  gaps ", "de", "b", 3), (12, "aaaa" * 200, "fr", "b", 3), (13, "aaaa" * 200, "fr", "b", 3),
    (13, "aaaa" * 200, "fr", "b", 3), (None, "nameless row", "fr", "b", 3), (None, "nameless row", "fr", "b", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "h", "k") for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0, 1), (5, 1, 0), (6, 1, None), (7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=repr)


ALL_IDS = sorted((r[0] for r in ODD), key=repr)


# --- 1 and 6: classifiers ------------------------------------------------------------------

@pytest.mark.parametrize("name, label", [("op1_quality_classifier", "quality"), ("op6_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    found = queries.QUERIES[name](spark, SF_LARGER).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_LARGER}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF_LARGER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) >= 0.95


@pytest.mark.parametrize("classify", [quality_classifier.classify, toxicity.classify])
def test_classifiers_on_odd_rows(odd, none, labels, classify):
    label = {"label": "quality"} if classify is quality_classifier.classify else {"label": "toxic"}
    assert ids(classify(odd, labels, **label)) == ALL_IDS
    assert classify(none, labels, **label).count() == 0
    assert ids(classify(odd, labels.limit(0), **label)) == ALL_IDS


def test_training_rows_leave_out_the_held_out_fold_and_are_bounded(docs, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = labelled.training_rows(docs, labels, "toxic", 30).collect()
    assert len(rows) == 30 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(1)

    def brute(s):  # the best segment, then the same left and right of it
        best = max(((sum(s[a:b]), -a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        a, b = -best[1], best[2]
        return brute(s[:a]) + [(a, b - 1)] + [(x + b, y + b) for x, y in brute(s[b:])]

    for _ in range(200):
        s = rng.normal(-0.3, 1, rng.integers(1, 14))
        total = np.concatenate(([0], np.cumsum(s)))
        k = np.flatnonzero(s > 0)
        assert [(a, b) for a, b, _ in toxicity.segments(np.stack((total[k], total[k + 1]), 1), k)] == brute(list(s))


def test_segments_of_a_long_text_with_falling_sums():
    n = 30_000
    s = np.tile([1.0, -1.5], n)
    total = np.concatenate(([0], np.cumsum(s)))
    k = np.flatnonzero(s > 0)
    began = time.process_time()
    assert toxicity.segments(np.stack((total[k], total[k + 1]), 1), k) == [(int(i), int(i), 1.0) for i in k]
    assert time.process_time() - began < 5


def test_every_letter_is_in_a_token_and_only_letters_are():
    def spans(*rows):
        raw = "".join(rows).encode()
        offsets = np.cumsum([0, *(len(x.encode()) for x in rows)])
        row, bucket, starts, ends = toxicity.tokens(np.frombuffer(raw, np.uint8), offsets)
        return [(int(r), raw[a:b].decode()) for r, a, b in zip(row, starts, ends)], bucket

    def plain(x):
        return [w for _, w in spans(x)[0]], spans(x)[1].tolist()

    words, plainly = plain("one two toxicity")
    for x in ("one\u00a0two\u2014toxicity", "\u201cone\u201d two \u2018toxicity\u2019", "one\u3001two \U0001f600toxicity"):
        assert plain(x) == (words, plainly)
    assert words == ["one", "two", "toxicity"]
    assert plain("\u00e9t\u00e9s\u00e9s")[1] == plain("\u00e9t\u00e9s\u00e9")[1] != plain("\u00e9t\u00e9s")[1]
    assert plain("\u4f60\u662f\u574f\u4eba\u3002\u597d")[0] == ["\u4f60\u662f", "\u662f\u574f", "\u574f\u4eba", "\u597d"]
    assert set(plain("\u574f\u4eba")[1]) < set(plain("\u4f60\u662f\u574f\u4eba")[1])
    long, held = plain("x" * 30 + "toxicity" + "y" * 30)
    assert len(long) == 64 and plainly[2] in held
    thai = "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e04\u0e23\u0e31\u0e1a"
    assert plain(thai)[0] == [thai[k:k + 4] for k in range(len(thai) - 3)]
    assert spans("", "a\u4f60b", "", "c \U00020000")[0] == [(1, "a"), (1, "\u4f60"), (1, "b"), (3, "c"), (3, "\U00020000")]
    assert plain("")[0] == plain("12 \u2014!")[0] == []


# --- 2: quality rules ----------------------------------------------------------------------

def base(x):
    w = re.findall(WORD, x)
    lines = [y for y in x.split("\n") if re.search(WORD, y)]
    threes = list(zip(w, w[1:], w[2:]))
    times = Counter(threes)
    held = {i + j for i, k in enumerate(threes) if times[k] > 1 for j in range(3)}
    repeats = len(held)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), repeats,
            len(w) < 50 or 100 * repeats > 50 * len(w))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics(spark, docs, odd):
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op2_quality_rules"](spark, SF).collect()}
    assert found == {d: base(x) for d, x in texts(docs).items()}
    got = quality_rules.judge(odd.drop("kept"))
    assert {(r.doc_id, *(r[c] for c in COLUMNS)) for r in got.collect()} == {(r[0], *base(r[1] or "")) for r in ODD}


def test_outliers_go_and_clean_rows_stay(spark, none):
    rng = np.random.default_rng(3)

    def text(k, marks=""):
        return " ".join(f"w{rng.integers(0, 10**7)}{marks}" for _ in range(int(rng.integers(80, 300))))

    rows = [(k, text(k, "$$$" if k % 20 == 0 else ""), "en", "a") for k in range(200)]
    found = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {d for d, kept in found.items() if not kept} == set(range(0, 200, 20))
    assert quality_rules.judge(none).count() == 0


def test_robust_distance_against_numpy(spark):
    rng = np.random.default_rng(5)
    names = ["x_words", "x_symbols"]
    x = rng.normal(size=(300, 2)) @ np.array([[1.5, 0.4], [0, 1]])
    x[:30] += 12
    d = spark.createDataFrame([("g", float(a), float(b)) for a, b in x], "group string, x_words double, x_symbols double")
    got = {(r.x_words, r.x_symbols): r.d2 for r in quality_rules.with_distance(d, quality_rules.robust_estimates(d, names), names).collect()}
    floor = np.diag([quality_rules.FLOORS[n] ** 2 for n in names])
    q = lambda v, p: np.sort(v)[int(np.ceil(p * len(v))) - 1]
    m = np.array([q(c, 0.5) for c in x.T])
    scale = np.maximum(1.4826 * np.array([q(abs(c - c0), 0.5) for c, c0 in zip(x.T, m)]), np.sqrt(np.diag(floor)))
    inverse = np.diag(1 / scale**2)

    def distance(m, inverse):
        return np.einsum("ij,jk,ik->i", x - m, inverse, x - m)

    def estimate(rows, factor):
        return rows.mean(0), np.linalg.inv(np.cov(rows.T, bias=True) * factor + floor)

    for _ in range(quality_rules.STEPS):
        d2 = distance(m, inverse)
        m, inverse = estimate(x[d2 <= q(d2, 0.75)], 0.75 / quality_rules.chi2(quality_rules.chi2_beyond(0.25, 2), 4))
    far = quality_rules.chi2_beyond(0.025, 2)
    m, inverse = estimate(x[distance(m, inverse) <= far], 0.975 / quality_rules.chi2(far, 4))
    assert np.allclose([got[tuple(r)] for r in x], distance(m, inverse), rtol=1e-6)
    assert (distance(m, inverse)[:30] > 50).all()


# --- 3 and 8: queries with a SQL twin --------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_LARGER).toPandas()
    want = connect(SF_LARGER).sql(queries.ORACLE[name]).df()
    assert len(got) and normal(got) == normal(want)


def test_licences_of_odd_rows(spark, odd, none):
    found = {r.doc_id: r.licences for r in licence_scan.scan(odd).collect()}
    assert found[9] == ["CC-BY-NC-4.0"] and found[1] == [] and ids(licence_scan.scan(odd)) == ALL_IDS
    assert licence_scan.scan(none).count() == 0
    parts = ["This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; ",
             "either version 3 of the License, or\n(at your option) any later version."]
    rows = spark.createDataFrame([(1, "".join(parts)), (2, parts[1] + " " + parts[0]), (3, "".join(parts).replace("version 3", "version 2"))], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in licence_scan.scan(rows).collect()} == {1: ["GPL-3.0-or-later"], 2: [], 3: ["GPL-2.0-or-later"]}


def test_licences_of_lines_and_of_wrapped_sentences_are_both_found(spark):
    gpl = "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."
    rows = [(1, f"Released under the MIT License\nSome words here.\n\n{gpl}"), (2, f"Released under the MIT License\n{gpl}"), (3, f"{gpl}\nLicensed under CC BY 4.0\nReleased under the MIT License\nAll rights reserved\nLicensed under the BSD License\nand more")]
    found = {r.doc_id: set(r.licences) for r in licence_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    both = {"MIT", "GPL-2.0-or-later"}
    assert found == {1: both, 2: both, 3: both | {"CC-BY-4.0", "proprietary", "BSD"}}


NOTICES = {
    "Apache-2.0": """Copyright 2020 Ann Name\n\nLicensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MIT": """MIT License\n\nCopyright (c) 2020 Ann Name\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.""",
    "BSD": "Copyright (c) 2020, Ann Name\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice.",
    "ISC": "Copyright 2020 Ann Name\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-2.0-or-later": "A program\n\nThis program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "A program\n\nThis program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
}


def test_published_notices_wrapped_and_unwrapped(spark):
    def wrapped(x, width):
        return "\n".join("\n".join(textwrap.wrap(line, width)) for line in x.split("\n"))

    rows = [(name, f(x)) for name, x in NOTICES.items() for f in (
        str, lambda x: wrapped(x, 40), lambda x: wrapped(x, 76), lambda x: "# " + wrapped(x, 60).replace("\n", "\n# "), lambda x: wrapped(x, 60).replace("\n", "\r\n"))]
    rows += [(n, NOTICES[n].split("\n\n", 1)[-1].replace("\n\n", " ")) for n in NOTICES]
    rows += [("MIT", f"{x}the MIT license{y}") for x in ("This project is licensed under ", "The source code of this is released\nunder ", "Licensed under ")
             for y in ("", ".", " - see the LICENSE file for details.", ", see [LICENSE](LICENSE.md)\n")]
    rows += [(None, x) for x in ("Nobody is licensed under the MIT license to sing.", "The MIT license", "Mozilla Public License, v. 1.1", NOTICES["MPL-2.0"].replace("v. 2.0", "v. 1.1"))]
    d = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.licences for r in licence_scan.scan(d).collect()}
    assert [(x, found[k]) for k, (n, x) in enumerate(rows) if found[k] != ([n] if n else [])] == []


# --- 4: token codes ----------------------------------------------------------------------------

def test_codes_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 8, 511, 512, 513, 5000):
        x = rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)
        codes = token_codes.Codes(token_codes.pack(x))
        assert len(codes) == n and (codes.between(0, n) == x).all()
        for i in rng.integers(0, n, min(n, 40)):
            assert codes[int(i)] == x[i] and (codes.between(int(i), n) == x[i:]).all()
    with pytest.raises(ValueError):
        token_codes.pack(np.array([2**20]), (8, 8))


def test_token_codes_equal_the_library(spark, docs, odd, none):
    tokenizer, start = Tokenizer.from_file(BYTES), 0
    found = {r.doc_id: r[1:] for r in queries.QUERIES["op4_token_codes"](spark, SF).collect()}
    for d, x in sorted(texts(docs).items()):
        tokens = [*tokenizer.encode(x, add_special_tokens=False).ids, 0]
        assert found[d] == (start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        start += len(tokens)
    got = token_codes.decode(token_codes.encode(odd, BYTES, block_ids=1000))
    assert ids(got) == ALL_IDS
    counts = Counter((r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in ODD)
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == counts
    assert token_codes.decode(token_codes.encode(none, BYTES)).count() == 0


# --- 5: Jaccard join ---------------------------------------------------------------------------

def shingles(x):
    w = re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), x or ""))
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(sets):
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("frequent, tile", [(100, 512), (3, 2)])
def test_jaccard_classes(spark, monkeypatch, frequent, tile):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "SHARE", 500 if tile > 2 else 2)
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 1_000_000 if tile > 2 else 40)
    rng = np.random.default_rng(7)
    base_ = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(60):  # one group of near copies, some too far from all others
        w = list(base_)
        for j in rng.integers(0, 60, rng.integers(0, 4)):
            w[j] = f"e{rng.integers(0, 10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, f"{PASSAGE} " + " ".join(f"o{rng.integers(0, 10**6)}" for _ in range(rng.integers(5, 60)))) for k in range(30)]
    rows += [(200, None), (201, ""), (202, "A b"), (203, "a B"), (204, "a b c"), (205, rows[0][1].upper())]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == classes({d: shingles(x) for d, x in rows})


def test_jaccard_query_and_odd_rows(spark, docs, odd, none):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert found == classes({d: shingles(x) for d, x in texts(docs).items()})
    got = {(r.doc_id, r.component_id) for r in jaccard_join.join(odd).collect()}
    assert {(4, 4), (5, 4), (7, 6), (13, 12), (1, 1), (2, 2), (3, 3), (None, None)} <= got
    assert ids(jaccard_join.join(odd)) == ALL_IDS and jaccard_join.join(none).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))] + [(200 + k, 201 + k) for k in range(30)] + [(300, 300 + k) for k in range(1, 40)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for _ in range(100):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root.get(a, a), root.get(b, b))
    assert found == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 7: pieces -----------------------------------------------------------------------------------

def cheapest(word, table, spelt):
    m = word.replace(piece_lattice.MARK, piece_lattice.OWN).replace(" ", piece_lattice.MARK)
    own = {piece_lattice.OWN: piece_lattice.MARK}
    best = [(0, 0, 0)] + [None] * len(m)
    for e in range(1, len(m) + 1):
        for s in range(max(0, e - 16), e):
            lost = (10**7 + ord(own.get(m[s], m[s])), 50 * piece_lattice.SCALE) if e == s + 1 else None
            hit = table.get(m[s:e]) or lost
            if hit:
                best[e] = min(best[e] or (10**18,), (best[s][0] + hit[1], hit[0], e - s))
    out, n = [], len(m)
    while n:
        out.append(best[n][1])
        n -= best[n][2]
    return [i for x in reversed(out) for i in ([x] if x < 10**7 else [spelt[b] for b in chr(x - 10**7).encode()])]


def test_pieces_are_the_cheapest_and_spell_the_text(spark, docs, odd, none):
    table = {p: (i, c) for p, i, c in piece_lattice.piece_table(PIECES)}
    spelt = piece_lattice.byte_ids(PIECES)
    known = texts(docs)
    few = dict(sorted(known.items())[:40])
    encoded = piece_lattice.encode(docs.where("doc_id < 40"), PIECES)
    assert {r.doc_id: r.ids for r in encoded.collect()} == {d: [i for w in piece_lattice.words_of(x) for i in cheapest(w, table, spelt)] for d, x in few.items()}
    decoded = {r.doc_id: r.decoded_sha256 for r in queries.QUERIES["op7_piece_lattice"](spark, SF).collect()}
    assert decoded == {d: hashlib.sha256(x.encode()).hexdigest() for d, x in known.items()}
    back = piece_lattice.decode(piece_lattice.encode(odd, PIECES), PIECES)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r[0], r[1] or "") for r in ODD)
    assert piece_lattice.encode(none, PIECES).count() == 0


def test_runs_of_spaces_and_long_words_take_the_cheapest_path(spark, monkeypatch):
    monkeypatch.setattr(piece_lattice, "LONGEST_WORD", 50)
    listed = piece_lattice.piece_table(PIECES)
    model = piece_lattice._model(PIECES)
    assert {i for i in range(model.get_piece_size()) if set(model.id_to_piece(i)) == {piece_lattice.MARK}} <= {i for _, i, _ in listed}
    table, spelt = {p: (i, c) for p, i, c in listed}, piece_lattice.byte_ids(PIECES)
    rng = np.random.default_rng(9)
    rows = ["       x", "a" + " " * 7 + "b", "if x:\n        return  1 \n\n   ", " ", " " * 300, " " * 77 + "end", "a" * 333, "internationalization" * 20, "\u65e5\u2581" * 120]
    rows += ["".join(rng.choice(list("etaoin sh\n\ue123"), 400)) for _ in range(6)]
    d = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in piece_lattice.encode(d, PIECES).collect()}
    assert got == {k: [i for line in re.findall(r"[^\n]+|\n", " " + x) for i in cheapest(line, table, spelt)] for k, x in enumerate(rows)}
    assert {r.doc_id: r.text for r in piece_lattice.decode(piece_lattice.encode(d, PIECES), PIECES).collect()} == dict(enumerate(rows))
    edges = piece_lattice.packed_edges(listed)
    for k, x in enumerate(rows):  # here, since workers have the usual bound
        sliced = piece_lattice.words_of(x, edges)
        assert all(len(w) <= 50 for w in sliced) and [i for w in sliced for i in cheapest(w, table, spelt)] == got[k]


def test_words_are_cut_where_no_piece_runs_over(spark, docs, monkeypatch):
    listed = piece_lattice.piece_table(PIECES)
    table, spelt = {p: (i, c) for p, i, c in listed}, piece_lattice.byte_ids(PIECES)
    edges = piece_lattice.packed_edges(listed)
    beside = {p[k:k + 2] for p in table for k in range(len(p) - 1)}
    words = sorted({w for x in texts(docs).values() for w in piece_lattice.words_of(x)})[::7] + [w for r in ODD for w in piece_lattice.words_of((r[1] or "")[:5000])]
    parts, many = piece_lattice.parts_of(words, *piece_lattice.neighbours(edges))
    assert "".join(parts) == "".join(words) and many.sum() == len(parts) and many.min() > 0
    at = 0
    for w, n in zip(words, many.tolist()):
        mine, at = parts[at:at + n], at + n
        assert "".join(mine) == w and [i for p in mine for i in cheapest(p, table, spelt)] == cheapest(w, table, spelt)
        m = [p.replace(piece_lattice.MARK, piece_lattice.OWN).replace(" ", piece_lattice.MARK) for p in mine]
        assert all(a[-1] + b[0] not in beside for a, b in zip(m, m[1:])) and all(p[k:k + 2] in beside for p in m for k in range(len(p) - 1))
    # A word's end mark or quote makes no lattice of its own, before or after a line end either.
    asked, lattice = [], piece_lattice.lattice
    monkeypatch.setattr(piece_lattice, "lattice", lambda words, *more: asked.append(words) or lattice(words, *more))
    rows = [(1, "lattice lattice### (lattice) lattice\nlattice\n\nlattice### 7lattice7"), (2, None), (3, "lattice###")]
    got = {r.doc_id: r.ids for r in piece_lattice.encode(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect()}
    assert got == {k: cheapest(" " + (x or ""), table, spelt) for k, x in rows}
    lattices = sorted(r.word for r in asked[0].collect())
    assert lattices == sorted({p for _, x in rows for p in piece_lattice.parts_of([" " + (x or "")], *piece_lattice.neighbours(edges))[0]})
    assert not any("lattice" in w and "#" in w or w != "\n" and "\n" in w for w in lattices)


def test_pieces_are_a_local_relation(spark, docs):
    """As an RDD of Python rows they would start workers of another kind on every executor, which stay."""
    plan = piece_lattice.encode(docs, PIECES)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation [piece" in plan


def test_workers_give_their_memory_back(spark, docs):
    def resident(_=None):
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        for b in batches:
            # Small things between those that stay: an allocator returns none of their pages by itself.
            held = [bytes(2000) for _ in range(60_000)]
            sizes.append(resident())
            kept.extend(held[::500])
            del held
            yield b

    sizes, kept = [], []
    batch = pa.RecordBatch.from_pydict({"x": [1]})
    assert [b.num_rows for b in workers.letting_go(run)(iter([batch, batch]))] == [1, 1]
    assert max(sizes) - resident() > 80 << 20
    tasks, mapped = [], type(docs).mapInArrow
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(docs), "mapInArrow", lambda self, f, *more, **named: tasks.append(f) or mapped(self, f, *more, **named))
        piece_lattice.decode(piece_lattice.encode(docs, PIECES), PIECES)
    # The tasks that hold whole texts: cutting them into words and spelling them again.
    assert all(hasattr(f, "__wrapped__") for f in (tasks[0], tasks[-1]))


# --- 8: mixing ---------------------------------------------------------------------------------

def test_targets_by_filling_again_and_again(spark):
    rng = np.random.default_rng(6)
    for sizes in ([100, 5, 3], [1000, 10, 10, 10, 500], [0, 7], list(map(int, rng.integers(0, 400, 12)))):
        rows = [(False, f"s{k:02}", n) for k, n in enumerate(sizes)]
        found = {r.source_key: r.target for r in mixing.targets(spark.createDataFrame(rows, "no_source boolean, source_key string, source_size long")).collect()}
        weight = {f"s{k:02}": (5, 2, 1)[k % 3] for k in range(len(sizes))}
        left, full = sum(sizes) * 1.5, {}
        while True:
            open_ = {s: w for s, w in weight.items() if s not in full}
            share = {s: (left - sum(full.values())) * w / sum(open_.values()) for s, w in open_.items()}
            over = {s: 2.0 * n for (_, s, n) in rows if s in share and share[s] > 2 * n}
            if not over:
                break
            full |= over
        assert found == pytest.approx(full | share)


def test_mixture_rows(spark, odd, none):
    mixed = {}
    shares = {r.doc_id: r for r in mixing.mix(odd.where("doc_id IS NOT NULL AND doc_id <> 13")).collect()}
    rows = mixing.mixture(odd.where("doc_id IS NOT NULL AND doc_id <> 13"))
    assert rows.columns == odd.columns
    for r in rows.collect():
        mixed[r.doc_id] = mixed.get(r.doc_id, 0) + len(re.findall(WORD, r.text or ""))
        assert (dict((x[0], x[1]) for x in ODD)[r.doc_id] or "").startswith(r.text)
    assert mixed == {d: r.taken for d, r in shares.items() if r.taken}
    for r in shares.values():
        assert r.taken <= 2 * r.size
    assert mixing.mix(none).count() == mixing.mixture(none).count() == 0 and ids(mixing.mix(odd)) == ALL_IDS


def test_mixture_of_rows_that_share_an_id_or_have_none(odd):
    found, wanted = Counter(), {}
    for r in mixing.mixture(odd).collect():
        found[r.source] += len(re.findall(WORD, r.text))
    for r in mixing.mix(odd).collect():
        wanted[None if r.no_source else r.source_key] = int(r.target)
    assert dict(found) == {s: n for s, n in wanted.items() if n}


# --- 9: repeated strings ---------------------------------------------------------------------------

def cut(known):
    seen, out = set(), {}
    for d in sorted(known):
        raw = known[d].encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(raw[p:p + 100])
        runs = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("frequent", [500, 2])
def test_repeats(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    found = {r.doc_id: r[1:] for r in queries.QUERIES["op9_suffix_dedup"](spark, SF).collect()}
    assert found == cut(texts(docs))


def test_repeats_in_odd_rows(spark, odd, none):
    rows = {r[0]: r[1] or "" for r in ODD if r[0] is not None}
    found = {r.doc_id: r[1:] for r in suffix_dedup.report(odd.where("doc_id IS NOT NULL")).collect()}
    assert found == cut(rows)
    assert suffix_dedup.report(odd).count() == len(ODD) and suffix_dedup.report(none).count() == 0
    kept = suffix_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and {r.t for r in kept.collect()} == {"x"}
    assert 13 not in ids(kept) and {1, 2, 3} <= set(ids(kept))


def test_only_anchors_above_the_bar_come_to_the_driver(spark, monkeypatch):
    def packed(*x):
        return (np.array(x, np.int64).tobytes(),)

    rows = [packed(3_000_000_000), packed([-5, 7, 8], [2000, 9000, 3000]), packed([1], [3001]), packed(1_000)]
    counts = spark.createDataFrame(rows, "places binary").repartition(2)
    brought = []
    arrow = type(counts).toArrow
    monkeypatch.setattr(type(counts), "toArrow", lambda self: brought.append(arrow(self)) or brought[-1])
    assert suffix_dedup._frequent(counts, 500).tolist() == [1, 7] and [t.num_rows for t in brought] == [2]
    assert suffix_dedup._frequent(counts, 5000).tolist() == [7] and len(suffix_dedup._frequent(counts.limit(0), 500)) == 0
    signed = spark.createDataFrame([packed([-5, 7], [600, 700])], "places binary")
    assert suffix_dedup._frequent(signed, 500).tolist() == [7, 2**64 - 5]


def test_blind_trie_classes():
    rng = np.random.default_rng(8)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1500] = data[:500]
    starts, group = rng.integers(0, 2900, 800), rng.integers(0, 3, 800)
    number = suffix_dedup.blind_classes(data, starts, group)
    keys = [(g, data[s:s + 100].tobytes()) for s, g in zip(starts, group)]
    assert len(set(zip(number.tolist(), keys))) == len(set(keys)) == len(set(number.tolist()))


# --- 10: fingerprints --------------------------------------------------------------------------------

def test_fingerprints(spark, docs, odd, none):
    known = texts(docs)
    found = {r.doc_id: r for r in queries.QUERIES["op10_fingerprints"](spark, SF).collect()}
    order = sorted(known, reverse=True)

    def paragraphs(x):
        return set(re.findall(r"[^\n]{200,}?[.!?](?=[ \t\n\x0b\f\r])|[^\n]+", x))

    def near(a, b):
        a, b = paragraphs(a), paragraphs(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    for d, n in zip(order, [*order[1:], order[0]]):
        x, half = known[d], len(known[d]) // 2
        edited = x[:len(x) - half] + known[n][:half]
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == pytest.approx((near(x, edited), near(x, known[n])))
    by_text = {}
    assert all(by_text.setdefault(known[d], r.fingerprint) == r.fingerprint for d, r in found.items())
    assert ids(fingerprints.compare(odd)) == ALL_IDS and fingerprints.compare(none).count() == 0
    assert ids(fingerprints.compare(odd.where("doc_id = 6"))) == [6]


def test_sketches_that_fail_are_made_larger(spark, monkeypatch):
    rows = [(list(range(n)), list(range(m, m + n))) for n, m in ((0, 0), (5, 0), (40, 20), (300, 299), (700, 1))]
    d = spark.createDataFrame(rows, "a array<long>, b array<long>").withColumns({c: F.transform(c, lambda x: F.xxhash64(x)) for c in "ab"})
    wanted = [len(set(a) ^ set(b)) for a, b in rows]
    assert [r.d for r in d.select(fingerprints.difference("a", "b").alias("d")).collect()] == wanted
    monkeypatch.setattr(fingerprints, "THIRDS", (8,))  # no larger sketch to try: the sets decide
    assert [r.d for r in d.select(fingerprints.difference("a", "b").alias("d")).collect()] == wanted


# --- shared parts and the pipeline -------------------------------------------------------------------

def test_words_are_told_apart():
    raw = np.frombuffer("a ab ba a\x0bé é \na".encode(), np.uint8)
    hashes, first, starts = numbered_words(raw, np.array([0, len(raw)]))
    names = re.findall(WORD, raw.tobytes().decode())
    assert list(first) == [0, len(names)] and len(starts) == len(names)
    assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))


def test_near_copies_of_rows_that_share_an_id_or_have_none(spark, odd):
    kept = corpus_pipeline.near_copies(spark, odd, SF)
    assert kept.columns == odd.columns
    wanted = classes({d: shingles(x) for d, x, *_ in ODD if d is not None})
    assert ids(kept) == sorted([*(d for d, (_, c) in wanted.items() if d == c), None], key=repr)
    # NULL ids beside a near copy with an id, one id for two texts that are not alike, repeated rows without words.
    rows = [(5, LONG), (None, LONG + " end"), (None, PASSAGE), (None, PASSAGE), (5, "one two three"), (7, "four five six"), (7, "four five six"), (8, " "), (8, " ")]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), SF)
    assert Counter(map(tuple, kept.collect())) == Counter([(5, LONG), (None, PASSAGE), (5, "one two three"), (7, "four five six"), (8, " ")])


def test_a_stage_gives_memory_of_the_driver_back(spark, none):
    """What the JVM has freed outside its heap, kept by glibc as long as a later piece is in use: before a stage, and as it writes."""
    native, pid = spark._jvm.org.apache.spark.unsafe.Platform, spark._jvm.java.lang.ProcessHandle.current().pid()

    def resident():
        with open(f"/proc/{pid}/status") as f:
            return int(re.search(r"VmRSS:\s+(\d+) kB", f.read())[1]) >> 10

    def freed():
        pieces = [native.allocateMemory(100_000) for _ in range(3000)]
        for p in pieces:
            native.setMemory(p, 1, 100_000)
        for p in pieces[:-1]:
            native.freeMemory(p)
        return resident()

    def stage(spark, docs, sf_dir):
        found.append((before, resident()))
        kept = freed()
        stored(docs)
        found.append((kept, resident()))
        return docs

    found, _ = [], stored(none)
    before = freed()
    corpus_pipeline.placed(0)(stage)(spark, none, SF)
    assert all(after < full - 150 for full, after in found) and len(found) == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_pipeline_stages(spark, docs):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        before, rows = rows, stage(spark, rows, SF).cache()
        held, known = {r.doc_id: r for r in rows.collect()}, texts(before) if "text" in before.columns else {}
        assert held and set(held) <= set(known)
        if name != "piece_lattice":
            assert rows.columns == docs.columns
        if name == "quality_rules":
            assert not any(base(held[d].text)[5] for d in held)
        if name == "jaccard_join":
            wanted = classes({d: shingles(x) for d, x in known.items()})
            assert set(held) == {d for d, (_, c) in wanted.items() if d == c}
        if name == "suffix_dedup":
            done = cut(known)
            assert all(len(held[d].text.encode()) <= done[d][0] - done[d][1] for d in held)
            assert all(held[d].text == known[d] for d in held if not done[d][1])
        if name == "mixture":
            sizes = Counter()
            for r in rows.collect():
                sizes[r.source] += len(re.findall(WORD, r.text))
            targets = {r.source_key: r.target for r in mixing.mix(before).select("source_key", "target").distinct().collect()}
            assert dict(sizes) == {s: int(t) for s, t in targets.items() if int(t)}
        if name == "piece_lattice":
            mixed = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in before.collect())
            assert Counter((r.doc_id, r.decoded_sha256) for r in rows.collect()) == mixed
    with_stages = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in with_stages.select("doc_id").collect()) == sorted(r.doc_id for r in rows.select("doc_id").collect())
