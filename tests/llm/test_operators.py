"""Each text operator against a plain version, on small tables with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderpulse.llm import (bpe, chat, components, decontamination, exact_dedup, licenses, ngram_join, quality, sharding,
                            substring_dedup, toxicity)
from orderpulse.llm.license_rules import rules
from orderpulse.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __suspect string, keep_id string, bucket int"
VOCABULARY = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "été", "x1"]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): copies, near copies, a shared passage, empty, null, short and long texts, a null id."""
    rng = random.Random(5)
    base, passage = sentence(rng, 120), sentence(rng, 60)
    rows = [(n, sentence(rng, rng.randrange(1, 80))) for n in range(30)]
    rows += [(n, base) for n in range(30, 40)]
    for n in range(40, 60):
        words = base.split()
        words[rng.randrange(len(words))] = f"new{n}"
        rows.append((n, " ".join(words)))
    rows += [(n, f"{sentence(rng, 30)}\n{passage}\t{sentence(rng, 30)}") for n in range(60, 75)]
    rows += [(75, None), (76, ""), (77, "   "), (78, "one"), (79, "one"), (80, "one two three four"),
             (81, " ".join(["same"] * 500)), (82, sentence(rng, 6_000)), (83, "é" * 3_000), (84, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None, "x", "y", 1) for i, t in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# Exact dedup

def expected_groups(texts):
    groups = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    return groups


@pytest.mark.parametrize("limit", [1 << 31, 32_768])
def test_exact_dedup(docs, texts, limit):
    got = by_id(exact_dedup.dedup_decisions(docs, max_filter_bits=limit), "keep_id", "group_size", "kept", "text_sha256")
    groups = expected_groups(texts)
    assert got == {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]),
                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts}


def test_exact_dedup_keeps_one_row_and_all_columns(docs, texts):
    rows = exact_dedup.drop_duplicates(docs.unionByName(docs))
    assert rows.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows.collect()) == sorted(max(g) for g in expected_groups(texts).values())


def test_exact_dedup_null_ids(spark, empty):
    rows = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b"), (None, "b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.dedup_decisions(rows).collect()), key=str)
    assert got == sorted([(None, 3, False), (3, 3, True), (None, None, True), (None, None, True)], key=str)
    assert exact_dedup.drop_duplicates(rows).count() == 2
    assert exact_dedup.dedup_decisions(empty).count() == exact_dedup.drop_duplicates(empty).count() == 0


# Sharding

def test_sharding_is_gapless_and_grows_only_into_the_new_shard(docs, texts):
    rows = sharding.assign_shards(docs, [1.0] * 7, [1.0] * 8, group_rows=3).collect()
    assert len(rows) == len(texts)
    for shard in range(7):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 7) for r in rows)
    sizes = {r.doc_id: (r["size"], r.text_crc32) for r in rows}
    import zlib
    assert sizes == {i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts}


def test_sharding_by_weight(spark, empty):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = dict(sharding.assign_shards(rows, [1.0, 2.0, 5.0]).groupBy("shard").count().collect())
    assert all(abs(counts[n] / 20_000 - w / 8) < 0.02 for n, w in enumerate([1, 2, 5]))
    assert sharding.assign_shards(empty, [1.0, 1.0]).count() == 0
    repeats = spark.createDataFrame([(None, None)] * 5 + [(1, "a")] * 4, "doc_id long, text string")
    got = sharding.assign_shards(repeats, [1.0] * 3).collect()
    assert len({(r.shard, r.slot) for r in got}) == 9
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


# Licences

PLACES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def scan_plainly(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    at = [(n, label) for phrase, label in PLACES for n in range(len(words)) if words[n:n + len(phrase.split())] == phrase.split()]
    return (len(words), len(at), min((n for n, _ in at), default=None), max((n for n, _ in at), default=None),
            sorted({label for _, label in at}))


LICENSED = [
    "Released under the MIT License. Under the MIT license, under the mit license!", "CC BY-NC 4.0; cc_by_nc", None, "",
    "Licensed under the Apache License, Version 2.0.", "xunder the mit license", "under the MITİ license",
    "word " * 3_000 + "CC-BY-NC", "Über cc by nc\u0085 cc by nc", "cc  by\nnc cc by nc cc", "\x7f Apache\tLicense: Version{2}",
]


def test_license_places(spark, empty):
    rows = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    got = by_id(licenses.scan_licenses(rows), "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {i: scan_plainly(t) for i, t in enumerate(LICENSED)}
    assert licenses.scan_licenses(empty).count() == 0


def test_license_overlaps(spark):
    rows = spark.createDataFrame([
        (1, "Licensed under the Apache License, Version 2.0"), (2, "SPDX-License-Identifier: GPL-3.0-or-later"),
        (3, "Creative Commons Attribution-ShareAlike 4.0 and the MIT license; public domain")], "doc_id long, text string")
    got = {r.doc_id: [d.label for d in r.detections] for r in licenses.scan_licenses(rows).collect()}
    assert got == {1: ["apache-2"], 2: ["gpl-3"], 3: ["cc-by-sa-4", "mit", "public-domain"]} or got[3][0] == "cc-by-sa-4.0"
    assert len(rules()) > 300
    assert all(re.compile(r.pattern) and r.keyword == r.keyword.lower() for r in rules())


def test_detections_are_disjoint_and_ranked(spark):
    listed = [licenses.Rule("aa", "aa bb cc", "long", 0.5), licenses.Rule("bb", "bb", "short", 0.9), licenses.Rule("cc", "cc dd", "tail", 0.4)]
    rows = spark.createDataFrame([(1, "aa bb cc dd bb")], "doc_id long, text string")
    found = licenses.scan_licenses(rows, signature_rules=listed, gates=("aa",)).first().detections
    assert [(d.label, d.start, d.stop) for d in found] == [("long", 0, 3), ("short", 4, 5)]


# Decontamination

def plain_shingles(text, n=5):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def item_shingles_plainly(text):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    return plain_shingles(text, min(5, len(words))) if words else set()


def holds(text, shingles):
    """Whether a text holds 0.8 of an item's shingles."""
    return bool(shingles) and len(shingles & plain_shingles(text, len(next(iter(shingles))))) >= 0.8 * len(shingles) - 1e-9


def test_decontamination(spark, docs, texts, empty):
    rng = random.Random(9)
    shared = dict(texts)[60].split("\n")[1].split("\t")[0].split()
    half = " ".join(shared[:30] + sentence(rng, 25).split())
    items = [(1, " ".join(shared)), (2, half), (3, "one two three four"), (4, None), (5, sentence(rng, 40)),
             (6, " ".join(shared[:40] + ["odd"] + shared[41:])), (7, dict(texts)[5]), (None, " ".join(shared))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for item, text in items:
        own = item_shingles_plainly(text)
        want |= {(i, item) for i, t in texts if item and holds(t, own)}
    assert (80, 3) in want  # the whole text is an item of four words
    got = decontamination.leaked_items(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    left = decontamination.drop_leaking(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in texts} - {i for i, _ in want}
    assert decontamination.leaked_items(empty, bench).count() == 0
    assert decontamination.drop_leaking(docs, bench.limit(0)).count() == len(texts)


# Byte-level BPE

def test_bpe_equals_the_library(spark, docs, texts):
    import tiktoken

    how = tokenizer()
    tokens = bpe.read_ranks(how["ranks_path"])
    library = tiktoken.Encoding("own", pat_str=how["pattern"], mergeable_ranks={t: n for n, t in enumerate(tokens)}, special_tokens={})
    assert base64.b64encode(tokens[0])
    encoded = bpe.encode_column(docs, **how)
    decoded = bpe.decode_column(encoded, how["ranks_path"])
    both = by_id(bpe.round_trip(docs, **how), "token_ids", "decoded")
    for r in decoded.collect():
        text = dict(texts)[r.doc_id] or ""
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text
        assert both[r.doc_id] == (r.token_ids, r.decoded)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60), st.integers(1, 3))
def test_bpe_on_any_text(text, times):
    import tiktoken

    how = tokenizer()
    if "encoder" not in _made:
        tokens = bpe.read_ranks(how["ranks_path"])
        _made["encoder"] = bpe.Encoder(tokens, how["pattern"])
        _made["library"] = tiktoken.Encoding("own", pat_str=how["pattern"], mergeable_ranks={t: n for n, t in enumerate(tokens)},
                                             special_tokens={})
    body = (text * times).encode("utf-8", "ignore").decode()
    assert np.frombuffer(_made["encoder"].encode([body])[0], "<u4").tolist() == _made["library"].encode_ordinary(body)


_made = {}


# Chat formatting

TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a </s> b"), (1, 2, "tool", "x\\y"), (1, 3, "assistant", ""),
         (2, 0, "system", None), (2, 0, "system", None), (2, 5, None, "[INST] ok [/INST]"), (2, None, "user", "first"),
         (None, 1, "assistant", "alone"), (3, 0, "assistant", "long " * 5_000)]


def conversations(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for conv, _, role, text in order:
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_chat_digests(spark):
    many = [(7, n, ("user", "assistant")[n % 2], f"turn {n} \\ <s>") for n in range(150)]
    rows = spark.createDataFrame(TURNS + many, "conv_id long, turn long, role string, text string").repartition(4)
    located = chat.locate_turns(rows)
    got = {r.conv_id: r for r in chat.digest_conversations(located).collect()}
    want = conversations(TURNS + many)
    assert set(got) == set(want)
    pieces = {}
    for r in located.collect():
        pieces.setdefault(r.conv_id, []).append((r.nth, r))
    for conv, turns in want.items():
        formatted = chat.render_instructions(turns)
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.formatted_chars, r.loss_chars, r.rewrites) == (len(turns), len(formatted), len(loss), 0)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        parts = [p for _, p in sorted(pieces[conv], key=lambda x: x[0])]
        assert "".join(p.piece for p in parts) == formatted
        assert [chat.unescape(formatted[p.text_start:p.text_stop]) for p in parts] == [t for _, t in turns]


def test_chat_templates_that_rewrite_or_look_back(spark):
    rows = spark.createDataFrame([(1, n, "user", f"t{n}") for n in range(80)], "conv_id long, turn long, role string, text string")
    counted = chat.Template(lambda turns: f"{len(turns)} turns:" + "".join(f"<{t}>" for _, t in turns))
    assert [r.rewrites for r in chat.locate_turns(rows, counted).orderBy("nth").collect()][1:] == [True] * 79
    numbered = chat.Template(lambda turns: "".join(f"{n}<{t}>" for n, (_, t) in enumerate(turns)))  # a window would miscount
    parts = [r.piece for r in chat.locate_turns(rows, numbered).orderBy("nth").collect()]
    assert "".join(parts) == numbered.render([("user", f"t{n}") for n in range(80)])
    upper = chat.Template(lambda turns: "".join(t.upper() for _, t in turns))
    assert not any(r.verbatim for r in chat.locate_turns(rows, upper).collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "[ROLE]"]),
                          st.text(alphabet=list("<s>/[]INST\\é \nROLEY"), max_size=30)), max_size=6))
def test_instruction_format_is_reversible(turns):
    formatted = chat.render_instructions(turns)
    assert chat.read_instructions(formatted) == turns
    assert not any(c in chat.escape(t) for c in chat.CONTROLS for _, t in turns)


# N-gram join and components

def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(n, n + 1) for n in range(300, 340)] + [(5, 5)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(len(root)):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard_plainly(texts):
    sets = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = {tuple(words[n:n + 5]) for n in range(max(1, len(words) - 4))} if words else set()
    near = {i: [j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
            for i in sets}
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            root[i] = min([root[i], *[root[j] for j in near[i]]])
    return {i: (min([i, *[j for j in near[i] if sets[j] == sets[i]]]), root[i], len(near[i])) for i in sets}


@pytest.mark.parametrize("limits", [{}, {"tile": 4, "block": 3}])
def test_jaccard_join(docs, texts, limits):
    got = by_id(ngram_join.jaccard_join(docs, settings=ngram_join.JoinSettings(**limits)), "set_id", "class_id", "n_links")
    assert got == jaccard_plainly(texts)


def test_near_duplicates_leave_one_of_each_class(docs, texts, empty):
    left = ngram_join.drop_near_duplicates(docs)
    want = jaccard_plainly(texts)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in want if want[i][1] == i)
    assert ngram_join.jaccard_join(empty).count() == ngram_join.drop_near_duplicates(empty).count() == 0


def test_pruning_tolerance():
    for n, least in ngram_join.JoinSettings().least_matches():
        assert 0 < least < 0.8 * n  # far below what a pair at the threshold shows


def test_near_duplicates_with_null_and_repeated_ids(spark):
    body = sentence(random.Random(1), 40)
    rows = spark.createDataFrame([(None, body), (4, body), (4, "other words here"), (4, body), (2, body)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.jaccard_join(rows).collect()), key=str)
    assert got == sorted([(None, 2, 3), (4, 2, 3), (4, 4, 0), (4, 2, 3), (2, 2, 3)], key=str)
    assert sorted(str(r.doc_id) for r in ngram_join.drop_near_duplicates(rows).collect()) == ["2", "4", "None"]


# Substring dedup

def passages_plainly(texts, window=20):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts}
    seen, gone = set(), {i: set() for i in words}
    for i in sorted(words):
        for n in range(len(words[i]) - window + 1):
            key = tuple(words[i][n:n + window])
            if key in seen:
                gone[i] |= set(range(n, n + window))
            seen.add(key)
    return {i: (len(w), len(gone[i]), " ".join(x for n, x in enumerate(w) if n not in gone[i])) for i, w in words.items()}


@pytest.mark.parametrize("limits", [{}, {"hot": 2, "bucket_bytes": 5_000, "remembered_bytes": 500}, {"run": 20}])
def test_substring_dedup(docs, texts, limits):
    got = by_id(substring_dedup.remove_repeats(docs, settings=substring_dedup.PassageSettings(**limits)), "n_words", "n_removed", "kept_text")
    assert got == passages_plainly(texts)


def test_substring_dedup_edges(spark, empty):
    body = sentence(random.Random(2), 30)
    rows = spark.createDataFrame([(None, body), (1, body), (1, body), (1, body + " more")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(rows).collect()), key=str)
    assert got[-1] == (None, 0) and sorted(n for i, n in got if i == 1) == [30, 30, 30]
    assert substring_dedup.remove_repeats(empty).count() == 0


# Quality and toxicity

def test_quality(spark, empty):
    rng = random.Random(4)
    good = [(n, sentence(rng, 60)) for n in range(150)]
    fair = [(n, sentence(rng, 50) + " scum idiot") for n in range(150, 250)]
    junk = [(n, " ".join(f"{w.upper()}!!" for w in sentence(rng, 40).split())) for n in range(250, 350)]
    docs = spark.createDataFrame(good + fair + junk + [(900, None), (901, "")], "doc_id long, text string")
    ratings = spark.createDataFrame([(n, 2 if n < 150 else 1 if n < 250 else 0) for n in range(0, 350, 2)] + [(5, None), (-1, 2)],
                                    "doc_id long, grade int")
    model = quality.fit_quality(docs, ratings, levels=3)
    assert (np.diff(model.thresholds) > 0).all()
    rows = {r.doc_id: r for r in quality.grade_documents(docs, model).collect()}
    unseen = [(r, 2 if i < 150 else 1 if i < 250 else 0) for i, r in rows.items() if i % 2 and i < 350]
    assert np.mean([r.selected == (g > 0) for r, g in unseen]) > 0.95
    assert np.mean([abs(r.expected_grade - g) for r, g in unseen]) < 0.25
    assert all(r.tails[0] >= r.tails[1] and abs(sum(r.tails) - r.expected_grade) < 1e-9 for r in rows.values())
    kept = quality.keep_selected(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.selected}
    assert quality.fit_quality(docs, ratings.limit(0), levels=3) is None
    assert quality.grade_documents(docs, None).where("selected").count() == 352
    assert quality.grade_documents(empty, model).count() == 0


def test_toxicity(spark, empty):
    rng = random.Random(6)
    rows, labels = [], []
    for n in range(900):
        words, toxic = sentence(rng, 40).split(), n % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["idiot", "grobnik" + rng.choice("abc"), "You moron!", "1d10t"])
        rows.append((n, " ".join(words)))
        labels.append((n, int(toxic)))
    docs = spark.createDataFrame(rows + [(-1, None), (-2, "")], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels[:600] + [(5, None), (-9, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([(got[n] >= 0.3) == bool(y) for n, y in labels[600:]]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[-1] == got[-2]
    assert any(e.startswith("grobnik") for e in model.lexicon)
    assert toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    score = rng.normal(size=300)
    at, chance = toxicity.isotonic(score, (rng.random(300) < 1 / (1 + np.exp(-2 * score))).astype(float))
    assert (np.diff(at) >= 0).all() and (np.diff(chance) >= 0).all() and 0 < chance[0] <= chance[-1] < 1
