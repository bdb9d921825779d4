"""Each operator on nulls, empty and long texts, ties, repeats, empty tables and clashing columns, and against brute force."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyloom.llm import common, decontaminate, exact_dedup, language_model, learning, licenses, near_dedup, packing, quality, sharding, token_counts, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length long, digest string, rep long, chunk long, slot long"
WORDS = ["alpha", "Beta", "gamma,", "delta", "eps", "Zeta", "eta", "theta", "iota", "kappa", "mu", "nu", "xi", "pi"]


def docs_of(spark, texts, start=0):
    """Rows with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(start + n, t, "en", "s", 1, 2, "d", 3, 4, 5) for n, t in enumerate(texts)], SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    long = prose(1, 30_000)
    texts = [None, "", " \t\n", "one", "two words", prose(2, 80), prose(2, 80), "A b  C", "a B c", long, long + " end", prose(3, 80) + "\n", prose(3, 80), "é ü x", "\x0b\x0c\r"]
    rows = docs_of(spark, texts)
    return rows.union(docs_of(spark, ["one"], 3)).union(spark.createDataFrame([(None, "one", None, None, None, None, None, None, None, None)], SCHEMA))


def sets_of(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(texts, k, percent):
    sets = {i: sets_of(t, k) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}, sets


def test_words_and_shingles_match_plain_python():
    texts = [None, "", "a", "  A b\x0bC d ", "x y", prose(5, 3000), "ß É e"]
    arr = pa.array(texts)
    got = collections.defaultdict(set)
    sizes = {}
    for first, _, data, bounds in common.Steps(arr):
        word, doc, _, _ = common.words(data, bounds)
        owner, value = common.shingles(word, doc, 3)
        start, length = common.runs(owner)
        sizes.update({int(owner[s]) + first: int(n) for s, n in zip(start, length)})
    for n, t in enumerate(texts):
        assert sizes.get(n, 0) == len(sets_of(t, 3)), t
    assert not got


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation_is_a_bijection(n):
    p = sharding.Permutation(n, 9)
    out = p.forward(np.arange(n))
    assert sorted(out.tolist()) == list(range(n)) and (p.inverse(out) == np.arange(n)).all()


def test_sharding(spark, odd):
    got = sharding.shard(odd, 5).collect()
    assert len(got) == odd.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    one = next(r for r in got if r.doc_id == 13)
    assert one.size == len("é ü x".encode()) + 16 and one.text_crc32 == zlib.crc32("é ü x".encode())
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.shard(odd.repartition(7), 5).collect()), key=repr)
    assert sharding.shard(odd.limit(0), 5).count() == 0


def test_sharding_against_plain_python(spark):
    """Shard and slot of each row from its number, by the network in Python integers."""
    n, shards, seed, rounds = 333, 7, 17, 6
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(docs_of(spark, [prose(i, 5) for i in range(n)]), shards, seed).collect()}
    whole = 2**64

    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % whole
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % whole
        return x ^ (x >> 31)

    half = ((n - 1).bit_length() + 1) // 2
    keys = [mixed((i * 0x9E3779B97F4A7C15 + seed) % whole) for i in range(1, rounds + 1)]

    def place(x):
        while True:
            left, right = x >> half, x % 2**half
            for k in keys:
                left, right = right, left ^ (mixed((right + k) % whole) % 2**half)
            x = right * 2**half + left
            if x < n:
                return x

    assert got == {i: (place(i) % shards, place(i) // shards) for i in range(n)}


def test_exact_dedup_and_its_index(spark, odd, tmp_path):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd).collect()}
    assert (3, 3, 3, True) in got and (None, 3, 3, False) in got
    assert (2, 2, 4, True) in got and (0, 2, 4, False) in got  # most code points first
    assert (7, 7, 1, True) in got  # case counts
    assert (11, 11, 2, True) in got and (12, 11, 2, False) in got
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    first, second = docs_of(spark, ["a b", "c"]), docs_of(spark, ["ab  ", "d", "c"], 10)
    index.ingest(first).collect()
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    assert {(r.doc_id, r.keep_id, r.kept) for r in again.ingest(second).collect()} == {(10, 0, False), (11, 11, True), (12, 1, False)}
    assert again.read().count() == 3
    # The same batch again, as after a crash, and from a catalogue that does not know the index.
    want = {(r.doc_id, r.keep_id, r.kept) for r in again.ingest(second).collect()}
    spark.sql(f"drop table {again.table}")
    later = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    assert want == {(r.doc_id, r.keep_id, r.kept) for r in later.ingest(second).collect()} == {(10, 0, False), (11, 11, True), (12, 1, False)}
    assert {(r.doc_id, r.kept) for r in later.ingest(first).collect()} == {(0, True), (1, True)}
    small = later.compacted(str(tmp_path / "small"))
    assert small.read().count() == 3 and {(r.doc_id, r.kept) for r in small.ingest(docs_of(spark, ["d", "e"], 20)).collect()} == {(20, False), (21, True)}
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark, odd):
    r = random.Random(4)
    texts = {}
    for family in range(12):
        base = prose(100 + family, 60 + family * 9).split()
        for copy in range(14):
            words = list(base)
            for _ in range(r.randrange(0, 9)):
                words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
            texts[len(texts)] = " ".join(words)
    shared = prose(999, 40)
    for n in range(60):
        texts[len(texts)] = shared + " " + prose(2000 + n, 15 + n)
    for k, percent in ((3, 85), (5, 80)):
        want, sets = components(texts, k, percent)
        got = near_dedup.near_duplicates(docs_of(spark, [texts[i] for i in range(len(texts))]), k, percent).collect()
        assert {x.doc_id: x.component_id for x in got} == want
        assert {x.doc_id: x.n_shingles for x in got} == {i: len(s) for i, s in sets.items()}
        assert all(x.kept == (x.doc_id == x.component_id) for x in got)
    found = near_dedup.near_duplicates(odd, 3, 85).collect()
    assert len(found) == odd.count()
    by = {x.doc_id: x for x in found}
    assert by[0].n_shingles == 0 and by[0].component_id == 0 and by[6].component_id == 5 and by[8].component_id == 7 and by[10].component_id == 9
    assert by[None].component_id is None and by[None].kept
    assert near_dedup.near_duplicates(odd.limit(0), 3, 85).count() == 0


def test_components_of_chains_and_hubs(spark):
    from skyloom.llm.components import connected_components

    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 160)}}


def test_masks_hit_every_accepted_window():
    for length in range(7, 14):
        for bad in itertools.combinations(range(length), decontaminate.allowed(length)):
            assert any(not any(o + i in bad for i, b in enumerate(m) if b == "1") for m in decontaminate.MASKS for o in range(length - len(m) + 1)), (length, bad)


def test_contamination(spark, odd):
    item = [f"w{n}" for n in range(30)]
    before = len(re.findall("[A-Za-z0-9]+", prose(1, 50)))
    swapped = list(item)
    for n in (3, 11, 17, 25):
        swapped[n] = "zz"
    spoiled = [w if n % 4 else "zz" for n, w in enumerate(item)]
    texts = [prose(1, 50) + " " + " ".join(item) + " " + prose(2, 50), prose(3, 30) + " " + " ".join(swapped), " ".join(spoiled), prose(4, 90), "tiny item here", "tiny item", None, " ".join(item[5:18]).upper() + "!"]
    bench = spark.createDataFrame([(1, " ".join(item), "x"), (2, "Tiny, item here", "x"), (3, None, "x"), (4, "", "x"), (1, " ".join(item), "x")], "item_id long, text string, source string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (4, 2), (7, 1)}
    assert got[0, 1].matched == 30 and got[0, 1].first_word == before and got[0, 1].end_word == before + 30 and got[1, 1].matched == 26
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0 and decontaminate.contaminated(odd.limit(0), bench).count() == 0
    assert decontaminate.contaminated(odd, bench).count() == 0


def shared_passages(docs, items):
    """Brute force: pairs with a window that has few enough substitutions, over all alignments."""
    found = set()
    for (i, a), (j, b) in itertools.product(enumerate(docs), enumerate(items)):
        n = min(13, len(b))
        for line in range(-len(b), len(a)):
            lo, hi = max(0, -line), min(len(b), len(a) - line)
            if n and any(sum(a[at + line + k] != b[at + k] for k in range(n)) <= (2 if n == 13 else 1 if n >= 7 else 0) for at in range(lo, hi - n + 1)):
                found.add((i, j))
    return found


def test_contamination_against_brute_force(spark):
    r = random.Random(12)
    items = [[r.choice("abcdefgh") for _ in range(n)] for n in (3, 5, 6, 7, 9, 12, 13, 14, 20, 40)] + [list("ab" * 9), ["a"] * 20, ["x", "y", "z"] * 6]
    docs = [[r.choice("abcdefgh") for _ in range(r.randrange(1, 60))] for _ in range(40)]
    for item in items:
        for _ in range(6):
            part = list(item[r.randrange(0, max(1, len(item) - 13)) :])
            for _ in range(r.randrange(0, 4)):
                part[r.randrange(len(part))] = "q"
            docs.append([r.choice("abcd") for _ in range(5)] + part + ["end"])
    docs += [["a"] * 400, list("ab" * 150), ["x", "y", "z"] * 50, ["a", "a", "b"] * 30]
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(items)], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs_of(spark, [" ".join(t) for t in docs]), bench).collect()}
    assert got == shared_passages(docs, items)


def test_places_with_equal_steps_are_one_row():
    place = np.array([0, 1, 2, 3, 9, 4, 8, 12, 14, 16, 30])
    value = np.array([7, 7, 7, 7, 7, 8, 8, 8, 8, 8, 8])
    _, step, start = decontaminate._equal_steps(np.zeros(11, np.int64), value, place)
    n = np.diff(np.append(np.flatnonzero(start), 11))
    got = [f + s * k for f, s, m in zip(place[start], step[start], n) for k in range(m)]
    assert got == place.tolist() and len(n) < 8


def test_best_fit_plan():
    plan = packing.best_fit_plan({6: 3, 4: 4, 2: 2, 10: 1}, 10)
    used = collections.defaultdict(list)
    for length, rank, per, first, offset in plan:
        count = {6: 3, 4: 4, 2: 2, 10: 1}[length]
        after = [p[1] for p in plan if p[0] == length and p[1] > rank]
        for i in range((min(after) if after else count) - rank):
            used[first + i // per].append((offset + i % per * length, length))
    assert len(used) == 5
    for spots in used.values():
        spots.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:])) and sum(n for _, n in spots) <= 10


def test_best_fit_plan_needs_no_more_sequences_than_best_fit_over_documents():
    r = random.Random(5)
    for limit, most in ((100, 60), (64, 64), (1024, 1024), (10, 7)):
        lengths = [r.randrange(1, most + 1) for _ in range(3000)]
        spaces: list[int] = []
        for n in sorted(lengths, reverse=True):  # plain best-fit decreasing
            fit = [i for i, space in enumerate(spaces) if space >= n]
            if fit:
                best = min(fit, key=lambda i: spaces[i])
                spaces[best] -= n
            else:
                spaces.append(limit - n)
        used = set()
        counts = collections.Counter(lengths)
        plan = packing.best_fit_plan(counts, limit)
        for length, rank, per, first, _ in plan:
            after = [p[1] for p in plan if p[0] == length and p[1] > rank]
            used |= {first + i // per for i in range((min(after) if after else counts[length]) - rank)}
        assert len(used) <= len(spaces) and len(used) >= -(-sum(lengths) // limit)


def test_packing(spark, odd):
    vocab = tokens.vocabulary()
    got = packing.pack(odd, 64, vocab, group_rows=8).collect()
    encode = tokens.Encoder(vocab[0])
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    want = collections.Counter()
    for doc_id, text in texts:
        ids = encode(text or "").tolist() + [2]
        n, start = -(-len(ids) // 64), 0
        for k in range(n):
            end = len(ids) - 64 * (n - 1 - k)
            want[doc_id, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
            start = end
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spots in by.values():
        spots.sort()
        assert spots[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:])) and sum(n for _, n in spots) <= 64
    assert packing.pack(odd.limit(0)).count() == 0


def test_encoder_matches_the_slow_one():
    json_path, ranks = tokens.vocabulary()
    fast, slow = tokens.Encoder(json_path, ranks), tokens.Encoder(json_path)
    for text in ["", "a", "Hello  world\n\n x", "<|endoftext|> y", "été Ünï 12345 $$$ 　日本語 \U0001f600", "  lead", "it's they'll " * 50, "x" * 5000]:
        assert fast(text).tolist() == slow(text).tolist(), text


def test_token_counts(spark, odd):
    got = {r.limit: r for r in token_counts.token_counts(odd, block=4).collect()}
    encode = tokens.Encoder(*tokens.vocabulary())
    sizes = [len(encode(r.text or "")) for r in odd.select("text").collect()]
    assert set(got) == set(sizes)
    for limit, r in got.items():
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes) and r.docs_within == sum(s <= limit for s in sizes) and r.total_tokens == sum(sizes)
    assert token_counts.token_counts(odd.limit(0)).count() == 0


def test_licenses(spark, odd):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nThe software is provided \"as is\", without warranty of any kind, express or implied."
    texts = ["x y.\nLicensed under the Apache License, Version 2.0.\nmore", "Released under the MIT License. Licensed under CC BY-NC 4.0.", mit, "no license at all", None, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 3.0.\nLicensed under CC BY-NC 4.0."]
    got = {r.doc_id: (r.n_sentences, r.licenses) for r in licenses.scan_licenses(docs_of(spark, texts)).collect()}
    assert got == {0: (1, "Apache-2.0"), 1: (2, "MIT,CC-BY-NC-4.0"), 2: (3, "MIT"), 3: (0, None), 4: (0, None), 5: (3, "CC-BY-NC-4.0,CC-BY-NC-3.0")}
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(odd.limit(0)).count() == 0
    assert {(r.n_sentences, r.identifiers, r.licenses) for r in licenses.scan_licenses(odd).collect()} == {(0, None, None)}


def test_spdx_lines_and_titles(spark):
    cases = {
        "// SPDX-License-Identifier: MIT\nint x;": "MIT",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0-or-later",
        "# SPDX-License-Identifier: Apache-2.0 OR MIT\n": "MIT,Apache-2.0",
        "x\n# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
        "SPDX-License-Identifier: CC-BY-SA-4.0\n": "CC-BY-SA-4.0",
        "SPDX-License-Identifier: Nonesuch-1.0": None,
        "the spdx mit text": None,
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\nPreamble": "GPL-3",
        "   GNU LESSER GENERAL PUBLIC LICENSE\n  Version 2.1, February 1999\n": "LGPL-2.1",
        "                                 Apache License\n                           Version 2.0, January 2004\n": "Apache-2.0",
        "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions": "MPL-2.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM": "CC0",
        '\n\t\t\t The "Artistic License"\n\n\t\t\t\tPreamble\n': "Artistic",
        "                 The Artistic License 2.0\n\n   Copyright (c) 2000-2006": "Artistic-2.0",
        "                GNU Free Documentation License\n                 Version 1.3, 3 November 2008\n": "GFDL-1.3",
        "  GNU Free Documentation License\n    Version 1.2, November 2002\n": "GFDL-1.2",
        "Permission is granted to copy, distribute and/or modify this document\nunder the terms of the GNU Free Documentation License, Version 1.3\nor any later version published by the Free Software Foundation;\nwith no Invariant Sections.": "GFDL-1.3-or-later",
        "                  GNU LIBRARY GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n": "LGPL-2",
        "    modify it under the terms. This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Library General Public\nLicense as published by the Free Software Foundation; either\nversion 2 of the License, or (at your option) any later version.": "LGPL-2-or-later",
        "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2\n--------------------------------------------\n": "PSF-2",
        'This program, "bzip2", the associated library "libbzip2", and all\ndocumentation, are copyright (C) 1996-2010 Julian R Seward.  All\nrights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n\n1. Redistributions of source code must retain the above copyright\n   notice, this list of conditions and the following disclaimer.\n\n2. The origin of this software must not be misrepresented; you must\n   not claim that you wrote the original software.\n\n3. Altered source versions must be plainly marked as such, and must\n   not be misrepresented as being the original software.\n': "bzip2",
        "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.\n2. Altered source versions must be plainly marked as such, and must not be\n   misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.": "Zlib",
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 1, or (at your option)\nany later version.\n\nYou can redistribute it and/or modify it under the terms of the GNU General Public License.\n": "GPL-1-or-later",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License.\n": "GPL",
        "This is free and unencumbered software released into the public domain.\n": "Unlicense",
        "To the extent possible under law, Some One has waived all copyright and related or neighboring rights to\nthis work.": "CC0",
    }
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs_of(spark, list(cases))).collect()}
    assert [got[n] for n in range(len(cases))] == list(cases.values())


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES."""


def test_whole_license_texts(spark):
    lesser = GPL.replace("GNU General", "GNU Lesser General").replace("program is", "library is").replace("version 3", "version 2.1").replace("Foundation,", "Foundation;")
    only = GPL.replace("either version 3 of the License, or\n(at your option) any later version", "version 2 of the License")
    notices = {"MIT": MIT, "BSD-2-Clause": BSD2 + BSD_END, "GPL-3-or-later": GPL, "LGPL-2.1-or-later": lesser, "GPL-2": only, "AGPL-3-or-later": GPL.replace("GNU General", "GNU Affero General"), "ISC": ISC, "Apache-2.0": APACHE, "MPL-2.0": MPL}
    cases = [*notices.items(), ("BSD-3-Clause", BSD2 + BSD_NAMES.format("the copyright holder") + BSD_END), ("BSD-3-Clause", BSD2 + BSD_NAMES.format("Google Inc.") + BSD_END)]
    flat = lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n"))
    forms = [lambda t: t, flat, lambda t: "".join(f"# {x}\n" for x in t.split("\n")), lambda t: "".join(f" * {x}\r\n" for x in t.split("\n")), lambda t: "A line without a stop\n" + t + "\nanother"]
    want = [name for name, _ in cases for _ in forms] + ["MIT"]
    texts = [f(t) for _, t in cases for f in forms] + ["no stop here\nReleased under the MIT License\nnor here"]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs_of(spark, texts)).collect()}
    assert [got[n] for n in range(len(texts))] == want


def test_backoff_scores(spark, odd):
    texts = ["a b a b", "b a c", "", None, "d", "A  b a b"]
    got = {r.doc_id: r for r in language_model.backoff_scores(docs_of(spark, texts), order=3, chunk_bytes=6).collect()}
    words = [re.findall(r"\S+", (t or "").lower()) for t in texts]

    def count(gram, skip):
        n = len(gram)
        return sum(tuple(w[i : i + n]) == gram for d, w in enumerate(words) if d != skip for i in range(len(w) - n + 1))

    for d, w in enumerate(words):
        total, rest = 0.0, sum(map(len, words)) - len(w)
        for i, x in enumerate(w):
            for n in (3, 2, 1):
                if n <= i + 1:
                    gram, factor = tuple(w[i - n + 1 : i + 1]), 0.4 ** (min(3, i + 1) - n)
                    if n == 1:
                        c = count(gram, d)
                        total += math.log(factor * (c / rest if c else 0.4 / (rest + 1)))
                    elif c := count(gram, d):
                        total += math.log(factor * c / count(gram[:-1], d))
                        break
        assert got[d].n_words == len(w) and got[d].log_score == pytest.approx(total, abs=1e-9), d
    assert language_model.backoff_scores(odd).count() == odd.count() and language_model.backoff_scores(odd.limit(0)).count() == 0


def test_first_lm_query_uses_two_words_of_context(spark, tmp_path):
    from skyloom.llm import queries

    docs_of(spark, ["a b c", "a b c x", "z b d", "q b d"]).write.parquet(f"{tmp_path}/documents.parquet")
    first = next(f for name, f in queries.QUERIES.items() if name.startswith("op5_"))
    got = {r.doc_id: r.log_score for r in first(spark, str(tmp_path)).collect()}
    assert got[0] == pytest.approx(math.log(1 / 10) + math.log(1 / 1) + math.log(1 / 1), abs=1e-3)  # after b alone, c is 1 of 3


def test_packed_numbers_come_back():
    x = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], np.uint64)
    assert (language_model._unpack(language_model._pack(x), np.uint64) == x).all()


def test_classifiers(spark, odd):
    r = random.Random(8)
    texts, rows = [], []
    for n in range(240):
        bad, ugly = n % 4 == 0, n % 3 == 0
        words = prose(n, 60).split()
        if ugly:
            for at in r.sample(range(60), 3):
                words[at] = r.choice(["idiotic", "idiots", "idiotism", "idiotish"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        texts.append(" ".join(words))
        rows.append((n, int(not bad), int(ugly)))
    docs, labels = docs_of(spark, texts), spark.createDataFrame([*rows, (None, 1, 1), (500, None, None)], "doc_id long, quality int, toxic int")
    for run, column, modulus, remainder in ((toxicity.score_toxicity, 2, 3, 1), (quality.score_quality, 1, 4, 2)):
        got = {x.doc_id: x for x in run(docs, labels).collect()}
        y = np.array([rows[i][column] for i in range(240)])
        held = np.array([got[i].held_out for i in range(240)])
        assert held.tolist() == [zlib.crc32(str(i).encode()) % modulus == remainder for i in range(240)]
        assert learning.auc(np.array([got[i].score for i in range(240)])[held], y[held]) > 0.95
        assert all(x.predicted == int(x.score >= 0.7) and 0 <= x.score <= 1 for x in got.values())
        assert run(odd, labels).count() == odd.count() and run(docs.limit(0), labels).count() == 0
        assert {x.score for x in run(odd, labels.limit(0)).collect()} == {run(odd, labels.limit(0)).first().score}


def test_quality_hangs_on_words(spark):
    """Labels that shape, repeats and length say nothing about, on words that no labelled row of training has: they are
    known by the company that they keep in rows without labels."""
    r = random.Random(12)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(400)]
    topics = [(words[:100], words[100:200]), (words[200:300], words[300:])]
    texts, labels = [], []
    for n in range(900):
        seen, unseen = topics[n % 2]
        held = zlib.crc32(str(n).encode()) % 4 == 2
        if n < 400:
            labels.append((n, n % 2))
        texts.append(" ".join(r.sample((unseen if held else seen) if n < 400 else seen + unseen, 60)))
    got = {x.doc_id: x for x in quality.score_quality(docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    held = [n for n in range(400) if got[n].held_out]
    assert len(held) > 60 and learning.auc(np.array([got[n].score for n in held]), np.array([n % 2 for n in held])) > 0.95


def test_toxicity_scores_against_plain_python():
    s = toxicity.Settings(bits=10)
    weights = np.random.default_rng(1).normal(size=1 << s.bits).astype(np.float32)
    texts = [None, "", "One idiot", "a  bb\tccc é", "x" * 40]

    def plain(text):
        low = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b" \t\n\x0b\x0c\r" else b for b in (text or "").encode())
        padded, total, count = b" " + low + b" " * 9, 0.0, 0
        for i in range(len(low) + 1):
            for size in s.sizes:
                gram = padded[i : i + size]
                if 32 in gram[1:-1]:
                    continue
                h = sum(int(toxicity._TABLES[j][c]) for j, c in enumerate(gram)) * 0x9E3779B97F4A7C15 % 2**64
                total, count = total + float(weights[h >> (64 - s.bits)]), count + 1
        return 1 / (1 + math.exp(-(total / max(count, 1) + 0.25)))

    got = toxicity.score(pa.array(texts, pa.string()), weights, 0.25, s)
    assert got == pytest.approx([plain(t) for t in texts], abs=1e-5)


def test_quality_inputs_against_plain_python(spark):
    s = quality.Settings(slots=6, dimensions=8)
    texts = ["aa bb, aa cc", "Bb aa!! 12", None, "", "aa", "dd aa bb dd dd"]

    def plain_tokens(text):
        h, _, shape = quality.tokens(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
        return [int(x) for x in h], shape.tolist()

    def index(h):
        v = np.zeros(s.dimensions)
        for j in range(s.marks):
            r = int(common.mix(np.array([(h + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            v[r % s.dimensions] += 1 if r >> 63 else -1
        return v

    table = np.zeros((1 << s.slots, s.dimensions))
    for t in texts:
        h, _ = plain_tokens(t)
        for i, k in itertools.product(range(len(h)), range(len(h))):
            if i != k and abs(i - k) <= s.window:
                table[h[i] >> (64 - s.slots)] += index(h[k])
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    table = table / np.where(norm > 0, norm, 1)
    got = quality.contexts(docs_of(spark, texts).repartition(3), s)
    assert got == pytest.approx(table, abs=1e-5)
    x = quality.pooled(pa.array(texts, pa.string()), got, s)
    for t, row in zip(texts, x):
        h, _ = plain_tokens(t)
        want = sum((index(v) / math.sqrt(s.marks) + table[v >> (64 - s.slots)] for v in h), np.zeros(s.dimensions)) / max(1, len(h))
        assert row[: s.dimensions] == pytest.approx(want, abs=1e-5)


def test_pipeline_against_brute_force(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    item = " ".join(f"w{n}" for n in range(30))
    base = prose(50, 100)
    texts = [prose(i, 80) for i in range(40)] + [base, base + " ", base.replace("alpha", "omega", 1) + " tail", prose(60, 20) + " " + item, *[" ".join(w.upper() + "!!" for w in prose(70 + i, 60).split()) for i in range(40)]]
    rows = [(n, t, "en", "s", len(t)) for n, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(n, int("!!" not in t)) for n, t in enumerate(texts)], "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {n: t for n, t in enumerate(texts) if "!!" not in t and item not in t and n != 40}  # 41 has more code points than 40
    want, _ = components(clean, 5, 80)
    assert got == {n for n, c in want.items() if n == c}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_pipeline_decides_rows_of_null_and_repeated_ids(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    item = " ".join(f"w{n}" for n in range(30))
    bad = lambda n: " ".join(w.upper() + "!!" for w in prose(70 + n, 60).split())
    rows = [(n, prose(n, 80)) for n in range(40)] + [(100 + n, bad(n)) for n in range(40)]
    labels = [(i, int(i < 100)) for i, _ in rows]
    odd = [(None, bad(50)), (None, prose(3, 80)), (None, prose(4, 80) + " tail"), (None, prose(60, 20) + " " + item), (None, prose(61, 80))]
    odd += [(200, prose(62, 80)), (200, bad(51)), (200, prose(63, 20) + " " + item), (201, prose(64, 80)), (201, prose(64, 80))]
    spark.createDataFrame(rows + odd, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.staged(stage(spark, docs, str(tmp_path)), "stage")
    got = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    # The shorter text of doc 4 has the smaller key, so the null row goes; copies of one text leave one row.
    assert got == collections.Counter(rows[:40] + [odd[4], odd[5], odd[8]])


def test_pipeline_stages_on_odd_tables(spark, odd, tmp_path):
    """Nulls, empty and long texts, ties, repeats, an empty table and columns with the stages' own names."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage in any of these texts"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = odd.withColumns({c: F.lit(1) for c in ("run", "part", "kind", "hub", "score", "kept", "keep_id", "component_id", "_number", "batch", "g", "piece")})
    texts = [r.text for r in odd.collect()]
    key = lambda t: "".join(t.split()) if t else ""
    want = {"quality": len(texts), "exact_dedup": len({key(t) for t in texts}), "decontamination": len(texts)}
    # Of the texts with words: the pairs of near copies are (A b C, a b c), (80 words, with a line's end) and (long, long + end).
    sets = components(dict(enumerate(texts)), 5, 80)
    want["near_dedup"] = sum(i == c for i, c in sets[0].items())
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, more, str(tmp_path))
        if name != "packing":
            assert got.columns == more.columns, name
            assert got.count() == want[name], name
        else:
            assert got.select("doc_id", "piece").distinct().count() <= got.count() and got.count() >= len(texts)
        assert stage(spark, more.limit(0), str(tmp_path)).count() == 0, name


def test_pipeline_stages_keep_the_values_of_other_columns(spark, tmp_path):
    """Columns with any names the stages could use come out as they went in, beside null and repeated ids."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(40, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage in any of these texts")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = [None, None, 1, 1, 1, 2, 3, None, 4, 4]
    texts = [prose(i, 30) for i in range(len(ids))]
    texts[9] = texts[8]  # exact and near dedup leave one of the two
    names = ["_number", "_first", "_own_id", "_d", "row_key", "_row_key", "ROW_NUMBER", "keeps_id", "n", "m", "h", "count", "a.b", "kept", "score"]
    rows = [(i, t, *[f"{name} {at}" for name in names]) for at, (i, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{name}` string" for name in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns, name
        found = collections.Counter(tuple(r) for r in got.collect())
        lost = collections.Counter(rows) - found
        assert not found - collections.Counter(rows), name
        want = 1 if name in ("exact_dedup", "near_dedup") else 0
        assert len(lost) == want and all(r[1] == texts[8] for r in lost), name


def test_language_model_on_repeated_rows(spark):
    same = spark.createDataFrame([(None, "a b c d")] * 40 + [(1, "a b x")], "doc_id long, text string")
    got = language_model.backoff_scores(same, order=3, chunk_bytes=20).collect()
    scores = {round(r.log_score, 9) for r in got if r.doc_id is None}
    n = 39 * 4 + 3
    assert len(got) == 41 and scores == {round(math.log(40 / n) + math.log(40 / 40) + math.log(39 / 40) + math.log(39 / 39), 9)}
