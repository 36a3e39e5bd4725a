"""Licence detection: ordered signature rules behind a keyword gate, overlaps resolved by interval and priority.

Everything happens inside a row, in built-in functions: no shuffle, and a document's rules never leave its task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import bound, text_of
from orderpulse.llm.license_rules import DENIED, Rule, gates_of, rules

#: Phrases that are always counted, overlapping or not, with the label each stands for.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all of ASCII but digits and letters.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def spaced_words(text: Column) -> Column:
    """The text's words with A-Z in lower case, a space before each and at the end; one space without words."""
    return F.translate(F.regexp_replace(_padded(text), _GAPS, " "), _UPPER, _LOWER)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _any_of(text: Column, parts: Sequence[str]) -> Column:
    """Whether the text holds a part; one between spaces must be a word."""
    def held(some: Sequence[str]) -> Column:
        return reduce(or_, [F.contains(text, F.lit(part)) for part in some], F.lit(False))

    words = [part.strip() for part in parts if part.startswith(" ")]
    if not words:
        return held(parts)
    alone = rf"(?<![0-9a-z])(?:{'|'.join(map(re.escape, words))})(?![0-9a-z])"
    shortest = [word for word in words if not any(other != word and other in word for other in words)]
    return held([part for part in parts if not part.startswith(" ")]) | (held(shortest) & F.rlike(text, F.lit(alone)))


def _whole(pattern: str) -> str:
    """The pattern on word borders: it takes the space before its first word and leaves the one after the last."""
    return f" (?:{pattern})(?= )"


def _places(spaced: Column, rule: Column) -> Column:
    """Where a rule matches: (start, stop, rank, label, confidence), counted in words."""
    between, hits = F.split(spaced, rule["pattern"], -1), F.regexp_extract_all(spaced, rule["pattern"], F.lit(0))
    total = lambda parts: F.aggregate(parts, F.lit(0), lambda n, x: n + _spaces(x))

    def place(found: Column) -> Column:
        return F.transform(found["hits"], lambda hit, n: bound(
            total(F.slice(found["between"], 1, n + 1)) + total(F.slice(found["hits"], 1, n)),
            lambda start: F.struct(
                start.alias("start"), (start + _spaces(hit)).alias("stop"), rule["rank"].alias("rank"),
                rule["label"].alias("label"), rule["confidence"].alias("confidence"))))

    return bound(F.struct(between.alias("between"), hits.alias("hits")), place)


def resolve(found: Column) -> Column:
    """Detections left after suppression, by start; no two of them overlap.

    A detection inside another's interval goes; of equal intervals the rule of higher priority stays. Where two
    overlap in part, the rule of higher priority stays, the one that starts first if both are the same rule. What was
    hidden by a detection that went itself gets another turn, until all that is left out overlaps something that stays.
    """
    # Sorted by start, longest first, then by rank, a detection can only lie inside the last one kept.
    order = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["stop"]).alias("back"), d["rank"].alias("rank"), d["stop"].alias("stop"),
        d["label"].alias("label"), d["confidence"].alias("confidence"))))

    def step(state: Column, d: Column) -> Column:
        kept, last = state["kept"], F.try_element_at(state["kept"], F.lit(-1))
        as_it_was = lambda now: F.struct(now.alias("kept"), state["lost"].alias("lost"))
        return (
            F.when(last.isNull() | (d["start"] >= last["stop"]), as_it_was(F.concat(kept, F.array(d))))
            .when((d["stop"] <= last["stop"]) | (d["rank"] >= last["rank"]), as_it_was(kept))
            .otherwise(F.struct(F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(d)).alias("kept"), F.lit(True).alias("lost"))))

    def turn(rows: Column) -> Column:
        """The winners of one pass, and whether one that had been kept lost to a later one."""
        return F.aggregate(rows, F.struct(F.slice(rows, 1, 0).alias("kept"), F.lit(False).alias("lost")), step)

    def again(rows: Column, state: Column) -> Column:
        apart = lambda d: ~F.exists(state["kept"], lambda k: (d["start"] < k["stop"]) & (k["start"] < d["stop"]))
        return F.when(~state["lost"], state).otherwise(bound(F.filter(rows, apart), lambda left: bound(turn(left), lambda new: F.struct(
            F.concat(state["kept"], new["kept"]).alias("kept"), new["lost"].alias("lost")))))

    # Each turn keeps at least one more, and ends the loop where nothing was lost.
    return bound(order, lambda rows: F.array_sort(F.aggregate(rows, turn(rows), lambda state, _: again(rows, state))["kept"]))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  signature_rules: Sequence[Rule] | None = None, phrases: Mapping[str, str] = PHRASES,
                  gates: Sequence[str] | None = None) -> DataFrame:
    """One row per row of `docs`: its id, n_words, the phrases' places and the rules' detections.

    `n_base`, `first_word`, `last_word`, `base_labels` count the places of `phrases` (words from 0; null
    without a place). `detections` holds rule, label, interval in words and confidence of what `resolve` leaves, save
    for what the text denies. A null text is empty and has no words; long texts are scanned whole. Rows are independent of each other:
    null and repeated ids change nothing. An empty table gives no rows; other columns are not looked at.
    Only a text that holds one of `gates`, in any case, is looked at: each phrase and rule must hold one. Without
    `gates` they are taken from the rules and phrases, so that none is missed.
    """
    listed = rules() if signature_rules is None else signature_rules
    gates = gates_of(listed, phrases) if gates is None else gates
    by_keyword: dict[str, list[Column]] = {}
    for n, r in enumerate(listed):
        by_keyword.setdefault(r.keyword, []).append(F.struct(
            F.lit(_whole(r.pattern)).alias("pattern"), F.lit(n).alias("rank"), F.lit(r.label).alias("label"),
            F.lit(float(r.confidence)).alias("confidence")))
    # Each keyword is looked for once, whatever the number of its rules.
    table = F.array(*[F.struct(F.lit(f" {k} ").alias("keyword"), F.array(*of).alias("rules")) for k, of in by_keyword.items()])
    any_phrase = _whole("|".join(phrases))
    body, spaced = text_of(text), F.col("spaced")
    # The explode keeps Catalyst from copying the text's preparation into each expression that uses it.
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.size(F.split(_padded(body), _GAPS)) - 2).cast("long").alias("n_words"),
        F.explode(F.array(F.when(bound(F.lower(body), lambda low: _any_of(low, gates)), spaced_words(body)))).alias("spaced"))
    tried = F.flatten(F.transform(F.filter(table, lambda g: F.contains(spaced, g["keyword"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(tried, lambda r: _places(spaced, r)))
    based = F.col("spaced").rlike(any_phrase)
    empty = F.array().cast("array<struct<start:int,back:int,rank:int,stop:int,label:string,confidence:double>>")
    count = lambda part: _spaces(part).cast("long")
    return rows.select(
        "doc_id", "n_words",
        F.when(based, F.regexp_count(spaced, F.lit(any_phrase))).otherwise(0).cast("long").alias("n_base"),
        F.when(based, count(F.substring(spaced, F.lit(1), F.regexp_instr(spaced, F.lit(any_phrase)) - 1)))
        .alias("first_word"),
        F.when(based, count(F.regexp_extract(spaced, f"(?s)^(.*){any_phrase}", 1))).alias("last_word"),
        F.when(based, F.filter(F.array(*[
            F.when(F.contains(spaced, F.lit(f" {phrase} ")), F.lit(label)) for phrase, label in sorted(phrases.items())]),
            lambda label: label.isNotNull())).otherwise(F.array().cast("array<string>")).alias("base_labels"),
        F.when(spaced.isNotNull(), F.filter(resolve(found), lambda d: d["label"] != DENIED)).otherwise(empty).alias("detections"))
