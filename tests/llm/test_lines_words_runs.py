"""Line dedup, spelling variants and periodic runs against plain versions, on small and awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderpulse.llm import common, line_dedup, periodic, spelling
from orderpulse.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, print int, gone string, word int, n string, chunk string"
SF = "/root/testdata/sf0.001"


def table(spark, rows, parts=4):
    """`rows` of (doc_id, text) beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, None, 2, "y", "z") for i, t in rows], SCHEMA).repartition(parts)


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# Line dedup

def lines_plainly(rows, min_chars=20, min_docs=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    often = {k: max(ids) for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if often.get(key(x), i) == (-1 if i is None else i) or key(x) not in often]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


FOOTER = "Subscribe to our Newsletter today"
LINES = [
    (1, f"a\n{FOOTER}\nb"), (2, f"  {FOOTER.upper()}\t\n{FOOTER}"), (3, f"{FOOTER}\n\nc\n{FOOTER}\n"), (4, "Ünïcode ÀÉ line of twenty+"),
    (5, "Ünïcode ÀÉ LINE of twenty+\r"), (6, "\vünïcode ÀÉ line of twenty+"), (7, None), (8, ""), (9, "\n\n"), (10, "short\nshort"),
    (11, "short"), (12, "short"), (None, f"x\n{FOOTER}"), (None, None), (13, "only in two documents, long\n" * 3),
    (14, "only in two documents, long"), (15, "nineteen characters"), (16, "nineteen characters"), (17, "nineteen characters"),
    (18, "exactly twenty chars"), (19, "exactly twenty chars"), (20, "exactly twenty chars"), (21, "exactly twenty chars"),
    (21, "exactly twenty chars\nand of the same id"), (22, "z" * 50_000 + "\n" + f"{FOOTER}\n" * 3_000), (22, f"{FOOTER}"),
    (30, "one id holds this three times"), (30, "one id holds this three times\n2"), (30, "one id holds this three times\n3"),
    (31, "İstanbul is not lower-cased here"), (32, "i̇stanbul is not lower-cased here"), (33, "İstanbul is not lower-cased here"),
]


@pytest.mark.parametrize("rows_to_broadcast", [1_000_000, 0])
def test_lines(spark, monkeypatch, rows_to_broadcast):
    monkeypatch.setattr(line_dedup, "small", lambda df: common.small(df, rows_to_broadcast))
    got = line_dedup.drop_repeated_lines(table(spark, LINES)).collect()
    assert sorted(map(tuple, got), key=str) == lines_plainly(LINES)


def test_repeated_rows_share_a_result(spark):
    rows = LINES[:6] * 5
    assert sorted(map(tuple, line_dedup.drop_repeated_lines(table(spark, rows)).collect()), key=str) == lines_plainly(rows)


@pytest.mark.parametrize("limits", [(1, 1), (5, 2), (30, 3)])
def test_lines_by_other_limits(spark, limits):
    got = line_dedup.drop_repeated_lines(table(spark, LINES), settings=line_dedup.LineSettings(*limits)).collect()
    assert sorted(map(tuple, got), key=str) == lines_plainly(LINES, *limits)


def test_lines_of_other_ids_and_empty_tables(spark):
    assert line_dedup.drop_repeated_lines(table(spark, [])).count() == 0
    named = spark.createDataFrame([("a", FOOTER), ("b", FOOTER), ("c", FOOTER)], "`the key` string, `a.text` string")
    got = line_dedup.drop_repeated_lines(named, "the key", "a.text").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 1, ""), ("b", 1, 1, ""), ("c", 1, 0, FOOTER)]


def test_texts_are_shuffled_once_at_most(spark):
    plan = line_dedup.drop_repeated_lines(table(spark, LINES))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "MapInPandas" not in plan and "CartesianProduct" not in plan


# Spelling variants

def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:n] + long[n + 1:] == short for n in range(len(long)))


def spelling_plainly(counts, min_chars=5, min_count=3, ratio=2):
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    out, forms = {}, {}
    for w, n in words.items():
        near = [x for x in words if is_near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near), forms[w], words[best] if forms[w] is not None else None)
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] += (root,)
    return out


def spelling_rows(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def random_words(seed, letters="abcé𝒳"):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))): rng.choice([1, 2, 3, 4, 6, 8, 16, 40]) for _ in range(400)} | {
        "a" * 3_000: 3, "a" * 2_999: 3, "a" * 2_999 + "b": 9}


@pytest.mark.parametrize("limits", [{}, {"chunk_words": 7, "lanes": 5}, {"chunk_words": 60, "lanes": 1_000, "ratio": 1 + 2}])
def test_spelling(spark, limits):
    counts = random_words(len(limits))
    words = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)] + [(None,)] * 5, "word string").repartition(3)
    got = spelling_rows(spelling.spelling_groups(words, spelling.SpellingSettings(**limits)))
    assert got == spelling_plainly(counts, ratio=limits.get("ratio", 2))


def test_forms_lead_to_a_root(spark):
    chain = {"abcde": 3, "abcdx": 6, "abcyx": 12, "abzyx": 24, "auzyx": 48, "auzyw": 47, "auzyv": 47}
    words = spark.createDataFrame([(w,) for w, n in chain.items() for _ in range(n)], "word string")
    got = spelling_rows(spelling.spelling_groups(words))
    assert got == spelling_plainly(chain)
    assert {got[w][-1] for w in ("abcde", "abcdx", "abcyx", "abzyx")} == {"auzyx"}
    ties = {"qbcde": 3, "qbcda": 6, "qbcdb": 6, "qbcdz": 6}
    words = spark.createDataFrame([(w,) for w, n in ties.items() for _ in range(n)], "word string")
    assert spelling_rows(spelling.spelling_groups(words))["qbcde"][2] == "qbcda"


def test_many_words_with_one_half(spark):
    rng = random.Random(9)
    counts = {"commonstart" + "".join(rng.choice("abcd") for _ in range(6)): 3 for _ in range(500)}
    counts |= {w[::-1]: 3 for w in list(counts)[:200]}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    limits = spelling.SpellingSettings(chunk_words=20, lanes=10)
    pairs = [spelling.near_pairs(vocab, limits, len(counts), reverse).collect() for reverse in (False, True)]
    got = [frozenset((r.word, r.near)) for found in pairs for r in found]
    words = list(counts)
    assert Counter(got) == Counter(frozenset((a, b)) for n, a in enumerate(words) for b in words[:n] if is_near(a, b))


def test_words_of_texts(spark):
    rows = [(1, "Été ÀB×c İx it's"), (2, None), (3, ""), (None, "Zed 12"), (1, "été")]
    got = Counter((r.id, r.word) for r in spelling.text_words(table(spark, rows)).collect())
    assert got == Counter([(1, "Été"), (1, "Àb×c"), (1, "x"), (1, "it"), (1, "s"), (None, "zed"), (1, "été")])
    assert spelling.spelling_groups(spelling.text_words(table(spark, []))).count() == 0


def test_spelling_query(spark):
    counts = Counter()
    for i, text in documents(spark):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    assert spelling_rows(QUERIES["op12_spelling_variants"](spark, SF)) == spelling_plainly(counts)


# Periodic runs

def runs_plainly(words, min_length=6, exponent=4):
    shortest = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                shortest.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in shortest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {n for s, length, q in found for n in range(s + q, s + length)}
    return " ".join(w for n, w in enumerate(words) if n not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=50), max_size=4), st.tuples(st.integers(2, 12), st.integers(2, 5)))
def test_runs_of_short_lists(lists, limits):
    assert periodic.runs_of(lists, periodic.RunSettings(*limits)) == [runs_plainly(words, *limits) for words in lists]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=4), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_stretches(stretches):
    words = [w for part, times in stretches for w in part * times]
    assert periodic.runs_of([words, words]) == [runs_plainly(words)] * 2


def test_runs_of_documents(spark):
    rng = random.Random(3)
    plain = " ".join(rng.choice(["ja", "nein", "été"]) for _ in range(200))
    rows = [(1, None), (2, ""), (3, " \t\v "), (4, "a a a a a"), (5, "a a a a a a"), (6, "x " + "a b c\n" * 4), (7, "a b " * 8), (8, plain),
            (None, "no " * 9), (9, "go\x0bgo\tgo go\r\ngo go stop"), (9, "go go go go go go"), (9, "go go go go go go"),
            (10, "w " * 20_000 + plain + " p q r" * 5_000)]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in periodic.find_runs(table(spark, rows)).collect()), key=str)
    expected = []
    for i, text in rows:
        words = [w for w in re.split("[ \t\n\v\f\r]+", text or "") if w]
        found = runs_plainly(words) if len(words) < 1_000 else got[[g[0] for g in got].index(10)][2]
        expected.append((i, len(words), found, collapsed(words, found)))
    assert got == sorted(expected, key=str)
    long = next(g for g in got if g[0] == 10)[2]
    assert long[0] == (0, 20_000, 1) and long[-1][1:] == (15_000, 3) and long[1:-1] == [
        (s + 20_000, n, q) for s, n, q in runs_plainly(plain.split())]
    assert periodic.find_runs(table(spark, [])).count() == 0


def test_longest_run(spark):
    rows = spark.createDataFrame([(1, []), (2, [(5, 8, 2), (1, 8, 1), (0, 7, 1)]), (3, [(1, 8, 2), (1, 8, 1)])],
                                 "doc_id int, runs array<struct<start: long, length: long, period: long>>")
    got = {r.doc_id: r.best and tuple(r.best) for r in rows.select("doc_id", periodic.longest_run(F.col("runs")).alias("best")).collect()}
    assert got == {1: None, 2: (1, 8, 1), 3: (1, 8, 1)}


def test_periodic_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    expected = {}
    for i, text in documents(spark):
        words = [w for w in re.split("[ \t\n\v\f\r]+", text or "") if w]
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        found = runs_plainly(words) if n < 4_000 else periodic.runs_of([words])[0]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        text_of_runs = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        expected[i] = (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                       *(hashlib.sha256(x.encode()).hexdigest() for x in (text_of_runs, collapsed(words, found))))
    assert got == expected
