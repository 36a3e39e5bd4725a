"""Cases in which a text operator once did less than the whole job."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderpulse.llm import chat, common, decontamination, licenses, ngram_join, quality, sharding, substring_dedup, toxicity
from orderpulse.llm.license_rules import gates_of, rules
from tests.llm.test_operators import holds, item_shingles_plainly, jaccard_plainly

# Licences

NOTICES = {
    "mit": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software to use it."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "0bsd": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\""],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice",
            "Redistribution and use in source and binary forms, with or without modification, are permitted."],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software.\n3. This notice may not be removed or altered from any source "
        "distribution.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely"],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation", "Covered by the GPL.", "https://www.gnu.org/licenses/gpl.html"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "public-domain": ["Dedicated to the public domain", "Public domain."],
    "cc0": ["CC0", "CC0 1.0 Universal", "Creative Commons Zero"],
    "all-rights-reserved": ["All rights reserved.", "word ALL RIGHTS RESERVED word", "Copyright (c) 2020 Société Ü. All rights reserved."],
    "proprietary": ["Proprietary and confidential.", "Confidential and Proprietary", "a proprietary licence"],
    "commercial": ["a commercial license agreement"],
    "eula": ["the End User License Agreement", "see our EULA"],
    "copyleft": ["strong copyleft"],
    "copyright": ["Copyright (c) 2019-2021", "Copyright © 2020 X", "copyright 1999"],
    "license-file": ["See the LICENSE file for details"],
    "gpl-3": ["GPLv3", "GPL-3.0", "GNU GPL v3 or later", "GPL version 3", "GPL3"],
    "gpl-2": ["GPLv2+", "GPL 2.0"],
    "lgpl-2.1": ["LGPLv2.1", "LGPL-2.1-or-later", "GNU LGPL 2.1"],
    "agpl-3": ["AGPLv3", "AGPL-3.0"],
    "mpl-2": ["MPL 2.0", "MPL-2.0", "MPLv2.0"],
    "epl-2": ["EPL-2.0"],
    "apache-2": ["Apache 2.0", "Apache-2.0", "Apache v2"],
    "bsd-3-clause": ["BSD-3-Clause", "3-clause BSD"],
    "": ["Apache 2.4.1 and 2.0", "for example 2.0", "an epl table", "permission denied", "reserved"],
}


GNU_NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as published by "
              "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
             "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
             "the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
             "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.\n")
BSD_ADS = ("3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
           "product includes software developed by the organization.\n")
BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
#: Texts, and the labels of what is found in them, in order.
TEXTS = [
    (GNU_NOTICE.format("General Public", "3"), ["gpl-3"]), (GNU_NOTICE.format("General Public", "2"), ["gpl-2"]),
    (GNU_NOTICE.format("Lesser General Public", "2.1"), ["lgpl-2.1"]), (GNU_NOTICE.format("Lesser General Public", "3"), ["lgpl-3"]),
    (GNU_NOTICE.format("Library General Public", "2"), ["lgpl-2"]), (GNU_NOTICE.format("Affero General Public", "3"), ["agpl-3"]),
    (BSD_START + BSD_END, ["bsd-2-clause"]), (BSD_START + BSD_NAMES + BSD_END, ["bsd-3-clause"]),
    (BSD_START + BSD_ADS + BSD_END, ["bsd-4-clause"]),
    ("https://creativecommons.org/licenses/by-sa/4.0/", ["cc-by-sa-4.0"]), ("http://creativecommons.org/licenses/by-nc-nd/3.0/de", ["cc-by-nc-nd-3.0"]),
    ("https://creativecommons.org/publicdomain/zero/1.0/", ["cc0"]), ("http://www.apache.org/licenses/LICENSE-2.0", ["apache-2"]),
    ("https://opensource.org/licenses/MIT", ["mit"]), ("https://opensource.org/license/bsd-3-clause/", ["bsd-3-clause"]),
    ("https://spdx.org/licenses/GPL-3.0-or-later.html", ["gpl-3"]), ("https://www.gnu.org/licenses/old-licenses/gpl-2.0.html", ["gpl-2"]),
    ("https://mozilla.org/MPL/2.0/.", ["mpl-2"]), ("https://www.eclipse.org/legal/epl-v10.html", ["epl-1"]),
    ("http://www.boost.org/LICENSE_1_0.txt", ["boost-1"]), ("<https://unlicense.org>", ["unlicense"]),
    ("Licence: MIT", ["mit"]), ('license = "MIT"', ["mit"]), ('"license": "BSD-3-Clause",', ["bsd-3-clause"]), ("License: Apache-2.0", ["apache-2"]),
    ("License :: OSI Approved :: MIT License", ["mit"]), ("license: GPL-3.0-only", ["gpl-3"]),
    ("MIT or Apache-2.0", ["mit", "apache-2"]), ("Apache-2.0 OR MIT", ["apache-2", "mit"]), ("Apache 2.0 / MIT", ["apache-2"]),
    ("GPL-2.0 or MIT", ["gpl-2", "mit"]), ("either mit or not", []), ("komm mit oder bleib", []),
    ("not released under the GPL", []), ("This is not licensed under the MIT license.", []), ("never distributed under the terms of the GPL version 3", []),
    ("not under the GPL but under the Apache License, Version 2.0", ["apache-2"]), ("It is not free. Released under the GPL v2", ["gpl-2"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy", ["mpl-2"]),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance", ["apache-2"]),
    ("The Software shall be used for Good, not Evil.", ["json"]),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
     "documentation covered by this license (the \"Software\")", ["boost-1"]),
    ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as "
     "long as the name is changed.", ["wtfpl"]),
    ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a "
     "written agreement is hereby granted", ["postgresql"]),
    ("As long as you retain this notice you can do whatever you want with this stuff.", ["beerware"]),
]


def test_each_notice_is_found_as_it_reads(spark):
    listed = [([label] if label else [], text) for label, texts in NOTICES.items() for text in texts] + [(labels, text) for text, labels in TEXTS]
    docs = spark.createDataFrame([(n, text) for n, (_, text) in enumerate(listed)], "doc_id long, text string")
    got = {r.doc_id: [d.label for d in r.detections] for r in licenses.scan_licenses(docs).collect()}
    assert [(text, got[n]) for n, (_, text) in enumerate(listed)] == [(text, labels) for labels, text in listed]


def resolve_plainly(found):
    """(start, stop, rank) that stay: in each turn the winners of one pass; then what overlaps none of them."""
    stay, left = [], sorted(found, key=lambda d: (d[0], -d[1], d[2]))
    while left:
        kept = []
        for d in left:
            if not kept or d[0] >= kept[-1][1]:
                kept.append(d)
            elif d[1] > kept[-1][1] and d[2] < kept[-1][2]:
                kept[-1] = d
        stay += kept
        left = [d for d in left if not any(d[0] < k[1] and k[0] < d[1] for k in kept)]
    return sorted(stay)


def detections_plainly(text, listed):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    spaced = " " + "".join(f"{w} " for w in words)
    found = []
    for rank, rule in enumerate(listed):
        for m in regex.finditer(f" (?:{rule.pattern})(?= )", spaced, regex.ASCII):
            start = spaced[:m.start()].count(" ")
            found.append((start, start + m.group().count(" "), rank))
    return [(s, e, listed[r].label, listed[r].confidence) for s, e, r in resolve_plainly(found) if listed[r].label]


def test_all_rules_equal_a_plain_scan(spark):
    """Every rule is tried on every text here, without keywords and gates."""
    rng, listed = random.Random(5), rules()
    texts = [t for _, ts in NOTICES.items() for t in ts] + [t for t, _ in TEXTS] + [None, "", "nothing at all"]
    for _ in range(40):
        parts = [rng.choice(texts) or "" for _ in range(rng.randrange(2, 5))]
        texts.append(rng.choice([" ", ", ", "\n", " or ", " not "]).join(p[rng.randrange(len(p) // 2 + 1):] for p in parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: [(d.start, d.stop, d.label, d.confidence) for d in r.detections] for r in licenses.scan_licenses(docs).collect()}
    for n, text in enumerate(texts):
        assert got[n] == detections_plainly(text, listed), text


def test_what_a_loser_hid_comes_back(spark):
    listed = [licenses.Rule("hh", "hh ii jj", "b", 0.9), licenses.Rule("aa", "aa bb cc dd ee ff gg hh", "a", 0.5), licenses.Rule("cc", "cc", "c", 0.5)]
    docs = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh ii jj")], "doc_id long, text string")
    assert [d.label for d in licenses.scan_licenses(docs, signature_rules=listed).first().detections] == ["c", "b"]


def test_suppression_of_random_intervals(spark):
    rng, rows = random.Random(6), []
    for n in range(400):
        found = {(a, a + rng.randrange(1, 9), rng.randrange(30)) for a in (rng.randrange(25) for _ in range(rng.randrange(0, 14)))}
        rows.append((n, [(s, e, r, str(r), 0.5) for s, e, r in sorted(found)]))
    docs = spark.createDataFrame(rows, "n int, found array<struct<start: int, stop: int, rank: int, label: string, confidence: double>>")
    got = {r.n: [(d.start, d.stop, d.rank) for d in r.left] for r in docs.select("n", licenses.resolve(F.col("found")).alias("left")).collect()}
    for n, found in rows:
        assert got[n] == resolve_plainly([d[:3] for d in found])
        assert all(a[1] <= b[0] for a, b in zip(got[n], got[n][1:]))


def test_license_scan_on_awkward_tables(spark):
    schema = "doc_id string, text string, keyword string, spaced string, rules int, detections string"
    rows = [("a", "Licence: MIT", "x", "y", 1, "z")] * 3 + [(None, "GPLv3 " * 4_000, None, None, None, None), (None, None, None, None, None, None)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), len(r.detections)) for r in got) == [("None", 0), ("None", 4_000), ("a", 1), ("a", 1), ("a", 1)]


def test_gates_lose_no_rule(spark):
    gates = gates_of(rules(), licenses.PHRASES)
    for rule in rules():
        assert any(g in f" {rule.keyword} " or g in rule.gate for g in gates), rule
        assert not rule.gate.strip() or rule.gate.strip() in rule.pattern, rule
    docs = spark.createDataFrame([(0, "nothing but a (Zebra)")], "doc_id long, text string")
    own = [licenses.Rule("zebra", "zebra", "zebra", 0.5), licenses.Rule("ox", "ox", "ox", 0.5)]
    assert [d.label for d in licenses.scan_licenses(docs, signature_rules=own).first().detections] == ["zebra"]


# Substring dedup

BODY = " ".join(f"w{n}" for n in range(40))


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("limits", [{}, {"hot": 0}, {"remembered_bytes": 0}])
def test_rows_that_repeat_id_and_text_keep_their_text(spark, parts, limits):
    settings = substring_dedup.PassageSettings(**limits)
    for doc_id in (1, None):
        rows = spark.createDataFrame([(doc_id, BODY)] * 2, "doc_id long, text string").repartition(parts)
        got = substring_dedup.remove_repeats(rows, settings=settings).collect()
        assert [(r.doc_id, r.n_removed, r.kept_text) for r in got] == [(doc_id, 0, BODY)] * 2
    rows = spark.createDataFrame([(1, BODY), (2, BODY), (1, BODY), (2, BODY)], "doc_id long, text string").repartition(parts)
    got = substring_dedup.remove_repeats(rows, settings=settings).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 40), (2, 40)]


def test_removed_windows_are_spread(spark):
    rows = spark.createDataFrame([(n, 0, BODY) for n in range(400)], "id long, print int, text string").coalesce(1)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        packed = substring_dedup.super_kmers(rows, substring_dedup.PassageSettings(), np.zeros(0, np.uint64), 64).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    sizes = Counter()
    for r in packed:
        sizes[r.bucket] += len(r.removed)
    assert sum(np.ptp(np.frombuffer(r.removed, np.int64).reshape(-1, 4)[:, 2:], 1).sum() + len(r.removed) // 32 if r.removed else 0
               for r in packed) == 399 * 21  # windows of 20 words in 40
    assert max(sizes.values()) < sum(sizes.values()) / 4


# Chat

def system_in_last_user_turn(turns):
    system = "".join(t for role, t in turns if role == "system")
    last = max((n for n, (role, _) in enumerate(turns) if role == "user"), default=-1)
    return "".join(f"<{role}:{system if n == last else ''}{t}>" for n, (role, t) in enumerate(turns) if role != "system")


def folded(turns):
    return f"({len(turns) - 64} left out)" + "".join(f"<{t}>" for _, t in turns[-64:]) if len(turns) > 64 else "".join(
        f"<{t}>" for _, t in turns)


@pytest.mark.parametrize("render", [system_in_last_user_turn, folded])
def test_late_rewrites_are_seen(spark, render):
    turns = [("system", "be kind"), ("assistant", "hello")] + [(("user", "assistant")[n % 2], f"t{n}") for n in range(100)]
    rows = spark.createDataFrame([(1, n, *t) for n, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = chat.locate_turns(rows, chat.Template(render)).orderBy("nth").collect()
    prefixes = [render(turns[:n]) for n in range(len(turns) + 1)]
    assert [r.rewrites for r in got] == [not b.startswith(a) for a, b in zip(prefixes, prefixes[1:])]
    assert [r.stop for r in got] == [len(p) for p in prefixes[1:]]
    assert all(p[r.start:r.stop] == r.piece for r, p in zip(got, prefixes[1:]))


# Sharding

def test_rows_that_share_a_key_are_spread_over_slot_groups(spark):
    rows = spark.createDataFrame([(None, f"text {n}") for n in range(300)], "doc_id long, text string")
    got = sharding.assign_shards(rows, [1.0, 1.0], group_rows=10).collect()
    assert len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(300))
    ordered = [(r.text_crc32, r["size"]) for r in sorted(got, key=lambda r: r.slot)]
    assert ordered != sorted(ordered)  # sorted as a whole if one group holds them all


# Decontamination

SHORT_ITEMS = [(1, "one two three four"), (2, "one two three four five"), (3, None), (4, "一二三四五六七八"), (5, "Two!"), (None, "one"),
               (6, "two three"), (6, "three four"), (7, "six seven six")]


def test_short_items_are_one_run_of_all_their_words(spark):
    texts = {1: "x one two three four y", 2: "One, two; three... four five", 3: "two one", 4: "前 一二三四五六七八。", 5: "three four one two",
             6: "six seven six seven", 7: "two three four", 8: None, 9: "", 10: "six seven"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame(SHORT_ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_found) for r in decontamination.leaked_items(docs, items).collect()}
    assert got == {(1, 1, 1, 1), (2, 1, 1, 1), (2, 2, 1, 1), (4, 4, 1, 1), (6, 7, 1, 1), *((n, 5, 1, 1) for n in (1, 2, 3, 5, 7)),
                   *((n, 6, 2, 2) for n in (1, 2, 7))}
    left = decontamination.drop_leaking(docs, items)
    assert {r.doc_id for r in left.collect()} == {8, 9, 10}


@pytest.mark.parametrize("rows", [0, 3])
def test_items_that_are_too_many_to_broadcast(spark, monkeypatch, rows):
    rng = random.Random(rows)
    body = {n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(60)) for n in range(30)}
    items = {n: " ".join(body[n].split()[5:5 + rng.choice([1, 3, 4, 9, 30])]) for n in range(0, 30, 3)}
    docs = spark.createDataFrame(list(body.items()), "doc_id long, text string")
    listed = spark.createDataFrame(list(items.items()), "item_id long, text string")
    expected = {(i, n) for n, item in items.items() for i, t in body.items() if holds(t, item_shingles_plainly(item))}
    monkeypatch.setattr(decontamination, "small", lambda df: common.small(df, rows))
    assert {(r.doc_id, r.item_id) for r in decontamination.leaked_items(docs, listed).collect()} == expected


# N-gram join

def test_rows_without_id_meet_only_their_own_class(spark):
    """Each text is looked up by id and hash: what is shingled again is about one row for each class."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    texts = []
    for n in range(60):
        words = list(base)
        words[n] = f"changed{n}"
        texts.append(" ".join(words))
    seen = spark.sparkContext.accumulator(0)
    plain = ngram_join.shingled

    def counted(docs, settings):
        seen.add(docs.count())
        return plain(docs, settings)

    for ids in ([None] * 60, [7] * 60, list(range(60))):
        seen.value = 0
        rows = spark.createDataFrame(list(zip(ids, texts)) * 2, "doc_id long, text string")
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(ngram_join, "shingled", counted)
            got = ngram_join.jaccard_join(rows).collect()
        assert seen.value <= 2 * 60 and len(got) == 120
        expected = jaccard_plainly(list(enumerate(texts * 2)))
        assert Counter(r.n_links for r in got) == Counter(links for _, _, links in expected.values())


def test_sets_travel_as_differences(spark):
    """Whatever the base, the exact check sees whole sets: chains whose ends share nothing, near copies, mixed blocks."""
    rng = random.Random(4)
    chain, words = [], [f"w{n}" for n in range(80)]
    for n in range(24):
        words = words[3:] + [f"x{n}-{k}" for k in range(3)]
        chain.append(" ".join(words))
    copies = [" ".join(f"c{k}" if k != n else f"changed{n}" for k in range(90)) for n in range(30)]
    rows = list(enumerate(chain + copies + ["same text of five words here"] * 3))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (4, 512):
        got = ngram_join.jaccard_join(docs, settings=ngram_join.JoinSettings(block=block)).collect()
        assert {r.doc_id: (r.set_id, r.class_id, r.n_links) for r in got} == jaccard_plainly(rows)
    sketches = ngram_join.sketch(docs, ngram_join.JoinSettings(), "doc_id", "text")
    sets = ngram_join.shingled(docs.join(sketches, "doc_id").withColumn("root", F.first("node").over(Window.orderBy("doc_id"))).withColumn(
        "members", F.lit(57).cast("long")).withColumn("copies", F.lit(1).cast("long")).drop("bands", "text_hash"), ngram_join.JoinSettings())
    plain = {r.doc_id: set(np.frombuffer(r.shingles, "<u8").tolist()) for r in sets.select("doc_id", "shingles").collect()}
    base = plain[0]
    by_node = {r.node: r for r in ngram_join.deltas(sets).collect()}
    for r in sets.select("doc_id", "node").collect():
        assert set(np.frombuffer(by_node[r.node].delta, "<u8").tolist()) == plain[r.doc_id] ^ base
        assert by_node[r.node].n_shingles == len(plain[r.doc_id])


# Samples

def test_samples_bound_documents_not_only_labels(spark, monkeypatch):
    """Documents that share a labelled id don't all come to the driver."""
    docs = spark.createDataFrame([(n % 10, f"text number {n} of {n % 7}") for n in range(600)], "doc_id long, text string")
    taken = []
    monkeypatch.setattr(quality, "fit_ordinal", lambda found, grades, levels: taken.append(len(found)))
    quality.fit_quality(docs, spark.createDataFrame([(n, n % 2) for n in range(10)], "doc_id long, grade int"), 2, sample_rows=8)
    monkeypatch.setattr(toxicity, "grow_trees", lambda x, y: taken.append(len(x)) or (0.0, []))
    monkeypatch.setattr(toxicity, "isotonic", lambda raw, y: taken.append(len(y)) or (np.zeros(1), np.zeros(1)))
    monkeypatch.setattr(toxicity.ToxicityModel, "raw", lambda self, x: np.zeros(len(x)))
    toxicity.fit_toxicity(docs, spark.createDataFrame([(n, n % 2) for n in range(10)], "doc_id long, toxic int"), sample_rows=9)
    assert taken[0] == 8 and sum(taken[1:]) <= 9
