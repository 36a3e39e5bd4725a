"""Fitted models and hashed shards against plain versions, and operators on awkward tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from orderpulse.llm import bpe, chat, exact_dedup, quality, sharding, toxicity
from orderpulse.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# Sharding

def shard_plainly(key, weights):
    """The least exponential draw, by a hash of our own: 64-bit xxhash of the key, seeded, and of the shard's number."""
    seed = 42 if key is None else xxhash.xxh64(key.to_bytes(8, "little", signed=True), 42).intdigest()
    draws = []
    for n, weight in enumerate(weights):
        h = xxhash.xxh64(n.to_bytes(4, "little"), seed).intdigest()
        draws.append((-math.log(((h >> 11) + 0.5) / (1 << 53)) / weight, n))
    return min(draws)[1]


def test_shards_equal_a_plain_hash(spark):
    for r in QUERIES["op5_rendezvous_sharding"](spark, SF).collect():
        assert (r.shard, r.grown_shard) == (shard_plainly(r.doc_id, [1.0] * 40), shard_plainly(r.doc_id, [1.0] * 41))
    weights = [0.5, 3.0, 1.0]
    rows = spark.createDataFrame([(n,) for n in [None, 0, -1, 1 << 62, *range(5, 300)]], "id long")
    for r in rows.select("id", sharding.rendezvous(F.col("id"), weights).alias("shard")).collect():
        assert r.shard == shard_plainly(r.id, weights)


def test_shard_sizes_and_checksums_are_those_of_the_texts(spark):
    texts = documents(spark)
    got = {r.doc_id: (r["size"], r.text_crc32) for r in QUERIES["op5_rendezvous_sharding"](spark, SF).collect()}
    assert got == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()}


# Trees and calibration

def gain_of(g, h, left, shrink):
    total = lambda own: g[own].sum() ** 2 / (h[own].sum() + shrink)
    return total(left) + total(~left) - g.sum() ** 2 / (h.sum() + shrink)


def best_split(x, g, h, cuts, least, shrink):
    """Exhaustive: every feature, every cut."""
    found = [(gain_of(g, h, x[:, f] < cut, shrink), f, cut) for f in range(x.shape[1]) for cut in cuts[f]
             if min((x[:, f] < cut).sum(), (x[:, f] >= cut).sum()) >= least]
    return max(found, default=(0, None, None))


@pytest.mark.parametrize("seed", range(4))
def test_trees_split_where_an_exhaustive_search_does(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(160, 4)), 1)
    y = (rng.random(160) < 1 / (1 + np.exp(-(2 * x[:, 1] - (x[:, 2] > 0.5) * 3)))).astype(float)
    base, trees = toxicity.grow_trees(x, y, trees=2, depth=2, rate=0.3, bins=16)
    assert base == pytest.approx(math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 17)[1:-1])) for c in x.T]
    score = np.full(len(y), base)
    for nodes, values in trees:
        chance = 1 / (1 + np.exp(-score))
        g, h = y - chance, chance * (1 - chance)
        leaf = np.zeros(len(y), int)
        for node in range(3):
            own = leaf == node
            if not own.any():
                continue
            gain, _, _ = best_split(x[own], g[own], h[own], cuts, 4, 1.0)
            if node not in nodes:
                assert gain <= 1e-6
                continue
            feature, cut = nodes[node]
            assert gain_of(g[own], h[own], x[own, feature] < cut, 1.0) == pytest.approx(gain, rel=1e-9)
            leaf[own] = 2 * node + 1 + (x[own, feature] >= cut)
        for n in set(leaf.tolist()):
            assert values[n] == pytest.approx(0.3 * g[leaf == n].sum() / (h[leaf == n].sum() + 1))
        score = score + np.array([values[n] for n in leaf])
    model = toxicity.ToxicityModel({}, base, trees, np.zeros(1), np.zeros(1))
    assert model.raw(x) == pytest.approx(score)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.booleans()), min_size=2, max_size=25))
def test_calibration_is_the_least_squares_monotone_one(rows):
    """The minimax form of isotonic regression, with equal scores as one."""
    score, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    levels = sorted(set(score.tolist()))
    sums, counts = [y[score == s].sum() for s in levels], [(score == s).sum() for s in levels]
    expected = [max(min(sum(sums[a:b + 1]) / sum(counts[a:b + 1]) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]
    at, chance = toxicity.isotonic(score, y, prior=0.0)
    assert [float(np.interp(s, at, chance)) for s in levels] == pytest.approx(expected)


def features_plainly(text, lexicon):
    """The sixteen numbers of a text, word by word."""
    facts = toxicity.WordFacts(lexicon)
    words = [np.array(facts(w), np.float32) for w in text.split()]
    if not words:
        return [0.0] * 16
    n, weights = len(words), [float(max(w[0], w[3])) for w in words]
    hits, you = [i for i, w in enumerate(weights) if w], [i for i, w in enumerate(words) if w[1]]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits)
    total = [float(sum(w[k] for w in words)) for k in range(9)]
    strong, letters = sum(w >= 3 for w in weights), max(1.0, total[5])
    distinct = len({text.split()[i] for i in hits})
    return [sum(weights) / n, strong / n, len(hits) / n, max(weights), math.log1p(strong), math.log1p(distinct), math.log1p(len(hits)),
            near / n, len(you) / n, total[4] / letters, total[6] / (letters + total[6]), total[7] / n, total[2] / n,
            math.log1p(sum(w[3] > 0 for w in words)), total[8] / n, math.log1p(n)]


def test_toxicity_query_equals_a_plain_scan(spark):
    docs, held_out = spark.read.parquet(f"{SF}/documents.parquet"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet").where(~held_out))
    got = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    for i, text in documents(spark).items():
        x = features_plainly(text, model.lexicon)
        raw = model.base
        for nodes, values in model.trees:
            leaf = 0
            while leaf in nodes:
                feature, cut = nodes[leaf]
                leaf = 2 * leaf + 1 + (x[feature] >= cut)
            raw += values.get(leaf, 0.0)
        at = int(np.searchsorted(model.at, raw))
        low, high = max(0, at - 1), min(at, len(model.at) - 1)
        share = 0.0 if model.at[high] == model.at[low] else (raw - model.at[low]) / (model.at[high] - model.at[low])
        chance = model.chance[low] + min(1.0, max(0.0, share)) * (model.chance[high] - model.chance[low])
        assert got[i].score == pytest.approx(0.99 * chance + 0.01 / (1 + math.exp(-raw)), abs=2e-3), i
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == int(got[i].score >= 0.3)


# Ordinal regression

def loss_plainly(weights, cuts, rows, grades, penalty):
    total = 0.0
    for (found, values), grade in zip(rows, grades, strict=True):
        score = sum(weights[f] * v for f, v in zip(found, values, strict=True))
        tails = [1.0, *[1 / (1 + math.exp(-(score - c))) for c in cuts], 0.0]
        total -= math.log(tails[grade] - tails[grade + 1])
    return total / len(rows) + penalty / 2 * sum(w * w for w in weights)


def test_fit_ends_where_differences_of_the_loss_vanish():
    rng = np.random.default_rng(3)
    truth = rng.normal(size=6) * 2
    rows = [(np.arange(6), rng.normal(size=6)) for _ in range(120)]
    grades = np.array([int(np.searchsorted([-1.5, 0.5, 2], truth @ v + rng.logistic())) for _, v in rows])
    model = quality.fit_ordinal(rows, grades, 4, rounds=4_000, rate=0.02, penalty=0.01)
    weights, cuts = model.weights[:6].astype(float).tolist(), model.thresholds.tolist()
    assert cuts == sorted(cuts) and not model.weights[6:].any()
    for k in range(9):
        def shifted(by, k=k):
            point = [*weights, *cuts]
            point[k] += by
            return loss_plainly(point[:6], point[6:], rows, grades, 0.01)
        assert abs(shifted(1e-4) - shifted(-1e-4)) / 2e-4 < 2e-3
    start = loss_plainly([0.0] * 6, [-1.0, 0.0, 1.0], rows, grades, 0.01)
    assert loss_plainly(weights, cuts, rows, grades, 0.01) < start


def test_quality_query_equals_a_plain_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(docs, quality.grades_of_labels(spark.read.parquet(f"{SF}/labels.parquet")), levels=3)
    got = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, SF).collect()}
    for i, text in documents(spark).items():
        words, counts = text.encode().split(), Counter()
        for w in words:
            counts.update(quality.word_features(w))
        for gap, feature in ((1, quality.SAME), (2, quality.SAME_BUT_ONE)):
            counts.update({feature: sum(a == b for a, b in zip(words, words[gap:]))})
        counts = Counter({f: n for f, n in counts.items() if n}) if words else Counter({quality.EMPTY: 1})
        total = sum(counts.values())
        score = sum(float(model.weights[f]) * math.sqrt(n / total) for f, n in counts.items())
        tails = [1 / (1 + math.exp(-(score - c))) for c in model.thresholds.tolist()]
        assert (got[i].p_good, got[i].p_best) == pytest.approx(tuple(tails), abs=1e-6)
        assert got[i].expected_grade == pytest.approx(sum(tails), abs=1e-6) and got[i].selected == (got[i].p_good >= 0.3)


# Awkward tables

WIDE = ("doc_id long, text string, lang string, source string, n_chars long, tails string, score int, token_ids int, decoded string, "
        "__both string, __id int, __hash string, __text string, id string, grade string, part int")
LONG = "good words and more of them " * 20_000


def wide(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 2, "y", "z", 3, "w", "v", "u", "g", 0) for i, t in rows], WIDE).repartition(3)


AWKWARD = [(1, "some good words"), (1, "some good words"), (1, "other words"), (None, "no id"), (None, None), (2, None), (3, ""), (4, " \t"), (5, LONG)]


def test_models_on_awkward_tables(spark):
    rated = [(100 + n, f"{'fine prose' if n % 2 else 'scum idiot!!'} number {n} of {n % 5}") for n in range(80)]
    docs, rows = wide(spark, rated + AWKWARD), wide(spark, AWKWARD)
    labels = spark.createDataFrame([(i, n % 2, 1 - n % 2) for n, (i, _) in enumerate(rated)] + [(1, 1, 0), (None, 1, 0), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, quality.grades_of_labels(labels), levels=3)
    graded = quality.grade_documents(rows, model).collect()
    assert len(graded) == len(AWKWARD) and all(len(r.tails) == 2 for r in graded)
    by_text = {i: [r for r, (j, t) in zip(sorted(graded, key=str), sorted(AWKWARD, key=str)) if j == i] for i in (1, None)}
    assert len(by_text[1]) == 3 and len({str(r.tails) for r in graded if r.doc_id in (2, 3, 4)}) == 1
    assert quality.keep_selected(rows, model).columns == rows.columns
    toxic = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(rows, toxic).collect()
    assert Counter(r.doc_id for r in scored) == Counter(i for i, _ in AWKWARD)
    assert len({r.score for r in scored if r.doc_id in (2, 3, 4)}) == 1 and all(0 <= r.score <= 1 for r in scored)


def test_bpe_on_awkward_tables(spark):
    got = bpe.round_trip(wide(spark, AWKWARD).drop("token_ids", "decoded"), **tokenizer())
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in got.collect()) == sorted((str(i), t or "") for i, t in AWKWARD)
    assert bpe.round_trip(wide(spark, []).drop("token_ids", "decoded"), **tokenizer()).count() == 0


def test_chat_on_awkward_tables(spark):
    schema = "conv_id long, turn long, role string, text string, piece string, start int, stop string, nth string, verbatim int, rewrites string"
    rows = [(c, t, r, x, "p", 1, "s", "n", 2, "w") for c, t, r, x in
            [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (None, None, None, None), (2, 0, "assistant", "x" * 300_000)]]
    got = {r.conv_id: r for r in chat.digest_conversations(chat.locate_turns(spark.createDataFrame(rows, schema).repartition(3))).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in got.items()} == {1: (3, 0), None: (1, 0), 2: (1, 300_000)}
    assert chat.digest_conversations(chat.locate_turns(spark.createDataFrame([], schema))).count() == 0


def test_exact_dedup_beside_a_map(spark):
    rows = spark.createDataFrame([(1, "a", {"x": 1}, 5), (2, "a", {"y": 2}, 4), (2, "a", {"z": 3}, 9), (None, "a", {}, 1), (3, "b", None, 0)],
                                 "doc_id long, text string, tags map<string, int>, c0 int")
    got = exact_dedup.drop_duplicates(rows)
    assert got.columns == rows.columns and got.schema["tags"].dataType == rows.schema["tags"].dataType
    assert sorted((r.doc_id, r.text, r.tags, r.c0) for r in got.collect()) == [(2, "a", {"z": 3}, 9), (3, "b", None, 0)]


def test_pipeline_on_awkward_tables(spark, tmp_path):
    near = [f"w{n}" for n in range(60)]
    rows = AWKWARD + [(10, " ".join(near)), (11, " ".join(["new", *near[1:]])), (12, "before the secret item of words after it")]
    tables = {"documents": wide(spark, rows),
              "labels": spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame([(1, "secret item of words"), (2, None)], "item_id long, text string")}
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / "full" / f"{name}.parquet"))
        (table if name == "labels" else table.limit(0)).limit(0).write.parquet(str(tmp_path / "empty" / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "full")).collect()
    # Of the texts without words the one with the largest id stays, as it does of any equal texts.
    assert sorted((str(r.doc_id), bytes(r.token_ids) != b"") for r in got) == [
        ("1", True), ("1", True), ("10", True), ("3", False), ("4", True), ("5", True), ("None", True)]
    docs = tables["documents"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path / "full"))
        assert docs.columns == tables["documents"].columns, name
    empty = corpus_pipeline.run(spark, str(tmp_path / "empty"))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "lang", "source"]
