"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: density, strength and variety of words of a lexicon, their nearness to a second person, capitals, punctuation
and obfuscation. The lexicon is a hand-written one and word beginnings that the labels show to be toxic. Lexicon, trees
and calibration each learn from a part of the labelled rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, short_batches, text_of, worker_cache
from orderpulse.llm.words import WordTable

#: At most so many labelled documents (those of least id hash) for a fit; entries of the learned lexicon.
SAMPLE_ROWS, LEXICON_ENTRIES = 20_000, 500
#: Parts of ten that lexicon, trees and calibration learn from.
LEXICON_PART, TREE_PART = 4, 8
#: Words counted as near a second person.
NEAR = 5

#: Common insults in English, French, German and Spanish, and words for the one spoken to.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb dumbass loser losers trash garbage scum scumbag clown clowns pathetic worthless
disgusting imbecile fool fools jerk jerks bastard bastards bitch asshole assholes shit bullshit fuck fucking fucker crap
hate ugly freak creep pig pigs rat vermin filth filthy liar coward lunatic psycho retard retarded degenerate parasite
idiote idiots imbécile crétin crétine débile abruti abrutie connard connasse salaud salope ordure merde minable
idiot dumm dummkopf trottel depp arschloch scheiße scheisse abschaum drecksau versager widerlich erbärmlich
idiota idiotas imbécil estúpido estúpida tonto tonta basura mierda asqueroso asquerosa patético patética cabrón puta payaso
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer
tú ti tus usted ustedes vosotros vuestro vuestra
""".split())
_LOOKALIKES = str.maketrans("013457@$!|+", "oieastasiit")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”‘’«»…–—¡¿"


def beginnings(word: str) -> list[str]:
    """The word and its first four to eight characters, as entries of a lexicon may stand for word beginnings."""
    return [word, *[f"{word[:n]}*" for n in range(4, 9) if len(word) >= n]]


def plain(word: str) -> str:
    return word.lower().strip(_EDGES)


class WordFacts:
    """Per word: lexicon weight, second person, obfuscated, weight once plain, capitals, letters, marks, loud marks, run."""

    WIDTH = 9

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        return max([3.0 if word in INSULTS else 0.0, *[self.lexicon.get(b, 0.0) for b in beginnings(word)]])

    def __call__(self, word: str) -> tuple:
        bare = plain(word)
        weight = self.weight(bare)
        mixed = bool(bare) and not bare.isalpha() and any(c.isalpha() for c in bare) and not bare.replace("'", "").replace("-", "").isalpha()
        hidden = "".join(c for c in word.lower().translate(_LOOKALIKES) if c.isalpha()) if mixed else ""
        run = any(a == b == c for a, b, c in zip(word, word[1:], word[2:], strict=False))
        return (weight, bare in SECOND_PERSON, mixed, self.weight(hidden) if hidden and not weight else 0.0,
                sum(c.isupper() for c in word), sum(c.isalpha() for c in word),
                sum(not c.isalnum() for c in word), word.count("!") + word.count("?"), run)


def dense(text: str, table: WordTable) -> np.ndarray:
    """The features of a text; zeros without words."""
    words = text.split()
    if not words:
        return np.zeros(FEATURES)
    numbers = table.numbers(words)
    facts = table.rows[numbers]
    weight, you = np.maximum(facts[:, 0], facts[:, 3]), np.flatnonzero(facts[:, 1])
    hits, n = np.flatnonzero(weight), len(words)
    near = 0
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(you[np.maximum(at - 1, 0)] - hits))
        near = int((gap <= NEAR).sum())
    total = facts.sum(0)
    letters, marks = max(1.0, total[5]), total[6]
    distinct = len(np.unique(numbers[hits]))
    strong = int((weight >= 3).sum())
    return np.array([weight.sum() / n, strong / n, len(hits) / n, weight.max(), np.log1p(strong), np.log1p(distinct),
                     np.log1p(len(hits)), near / n, len(you) / n, total[4] / letters, marks / (letters + marks),
                     total[7] / n, total[2] / n, np.log1p((facts[:, 3] > 0).sum()), total[8] / n, np.log1p(n)])


FEATURES = 16


def grow_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48,
               least: float = 4.0, shrink: float = 1.0) -> tuple[float, list]:
    """Boosted trees for the logistic loss, by histograms of gradients. A tree is a list of levels (feature, cut) and leaves."""
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(c, column, "right") for c, column in zip(cuts, x.T, strict=True)])
    score, grown = np.full(len(y), base), []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = y - chance, chance * (1 - chance)
        leaf, nodes = np.zeros(len(y), np.int64), {}
        for level in range(depth):
            for node in range((1 << level) - 1, (2 << level) - 1):
                own = np.flatnonzero(leaf == node)
                if not len(own):
                    continue
                g, h = slope[own].sum(), bend[own].sum()
                best = (1e-6, None, None)
                for f in range(x.shape[1]):
                    if not len(cuts[f]):
                        continue
                    left_g = np.cumsum(np.bincount(binned[own, f], slope[own], len(cuts[f]) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(binned[own, f], bend[own], len(cuts[f]) + 1))[:-1]
                    left_n = np.cumsum(np.bincount(binned[own, f], minlength=len(cuts[f]) + 1))[:-1]
                    gain = left_g**2 / (left_h + shrink) + (g - left_g) ** 2 / (h - left_h + shrink) - g**2 / (h + shrink)
                    gain[(left_n < least) | (len(own) - left_n < least)] = 0
                    if gain.max() > best[0]:
                        best = (gain.max(), f, int(gain.argmax()))
                if best[1] is None:
                    continue
                nodes[node] = (best[1], float(cuts[best[1]][best[2]]))
                leaf[own] = 2 * node + 1 + (binned[own, best[1]] > best[2])
        values = {n: float(rate * slope[leaf == n].sum() / (bend[leaf == n].sum() + shrink)) for n in np.unique(leaf).tolist()}
        score = score + np.array([values[n] for n in leaf.tolist()])
        grown.append((nodes, values))
    return base, grown


def isotonic(score: np.ndarray, y: np.ndarray, prior: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: ascending scores and the calibrated chance at each, drawn to the mean by `prior` rows."""
    # Equal scores are one row from the start: pooled one by one, some would go with the scores below.
    levels, place = np.unique(score, return_inverse=True)
    mean, blocks = float(y.mean()), []
    for s, total, count in zip(levels.tolist(), np.bincount(place, y).tolist(), np.bincount(place).tolist(), strict=True):
        blocks.append([total, count, s, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            up = blocks.pop()
            blocks[-1] = [blocks[-1][0] + up[0], blocks[-1][1] + up[1], blocks[-1][2], up[3]]
    at = np.array([x for b in blocks for x in (b[2], b[3])])
    chance = np.repeat([(b[0] + prior * mean) / (b[1] + prior) for b in blocks], 2)
    return at, np.maximum.accumulate(chance)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    base: float
    trees: list = field(repr=False)
    at: np.ndarray = field(repr=False)
    chance: np.ndarray = field(repr=False)

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for nodes, values in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for node in sorted(nodes):  # a parent comes before its children
                feature, cut = nodes[node]
                own = leaf == node
                leaf[own] = 2 * node + 1 + (x[own, feature] >= cut)
            score += np.array([values.get(n, 0.0) for n in range(int(leaf.max(initial=0)) + 1)])[leaf]
        return score

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated chances; within a step of the calibration the trees still decide the order."""
        raw = self.raw(x)
        return 0.99 * np.interp(raw, self.at, self.chance) + 0.01 / (1 + np.exp(-raw))


def _table(lexicon: dict[str, float]) -> WordTable:
    cache = worker_cache("toxicity")
    name = xxhash.xxh3_64_intdigest(repr(sorted(lexicon.items())))
    if name not in cache:
        cache.clear()
        cache[name] = WordTable(WordFacts(lexicon), WordFacts.WIDTH, np.float32)
    return cache[name]


def learn_lexicon(rows: DataFrame, entries: int) -> dict[str, float]:
    """Word beginnings whose documents are toxic far more often than others, with their log odds; rows are (text, toxic)."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for body, label in zip(batch["text"], batch["toxic"], strict=True):
                for entry in {b for w in set(map(plain, body.split())) if w.isalpha() for b in beginnings(w)}:
                    counts.setdefault(entry, [0, 0])[int(label)] += 1
            yield pd.DataFrame([(e, *n) for e, n in counts.items()], columns=["entry", "clean", "toxic"])

    sums = rows.mapInPandas(counted, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    odds = F.log((F.col("toxic") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(0, 0) + 1))
    best = sums.where("toxic >= 3").select("entry", odds.alias("odds"), "toxic").where("odds >= 1.5").orderBy(
        F.desc(F.col("odds") * F.log1p("toxic")), "entry").limit(entries)
    return {r.entry: min(6.0, float(r.odds)) for r in best.collect()}


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", *,
                 sample_rows: int = SAMPLE_ROWS, entries: int = LEXICON_ENTRIES) -> ToxicityModel | None:
    """The model, from at most `sample_rows` labelled documents; None without a row of either label in a part.

    Only the lexicon and the few numbers per sampled document come to the driver, where the trees grow. Labels other than 0 and
    1 and labels without document are left out.
    """
    short_batches(docs.sparkSession)
    part = F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(10))
    sample = (
        labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("__id"), F.col(label).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("__id"), "__id", "toxic").limit(sample_rows))
    rows = docs.select(F.col(key).alias("__id"), text_of(text).alias("text")).join(F.broadcast(sample), "__id").withColumn("part", part)
    lexicon = learn_lexicon(rows.where(part < LEXICON_PART).select("text", "toxic"), entries)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table = _table(lexicon)
            yield pd.DataFrame({"id": batch["__id"], "part": batch["part"], "toxic": batch["toxic"],
                                "x": [dense(body, table) for body in batch["text"]]})

    made = rows.where(part >= LEXICON_PART).mapInPandas(features, "id long, part long, toxic int, x array<double>")
    # The sample bounds labels; documents that share a labelled id are bounded here.
    made = kept(made.orderBy(F.xxhash64("id"), "id", "toxic", "x").limit(sample_rows)).toPandas()
    made = made.sort_values(["id", "toxic"], kind="stable")
    x = np.array(made["x"].tolist(), np.float64).reshape(-1, FEATURES)
    y, tree_part = made["toxic"].to_numpy(np.float64), made["part"].to_numpy() < TREE_PART
    if not 0 < y[tree_part].sum() < tree_part.sum() or tree_part.all():
        return None
    base, trees = grow_trees(x[tree_part], y[tree_part])
    grown = ToxicityModel(lexicon, base, trees, np.zeros(1), np.zeros(1))
    at, chance = isotonic(grown.raw(x[~tree_part]), y[~tree_part])
    return ToxicityModel(lexicon, base, trees, at, chance)


def toxicity_score(model: ToxicityModel, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bodies in batches:
            table = _table(model.lexicon)
            yield pd.Series(model.scores(np.array([dense(body, table) for body in bodies]).reshape(-1, FEATURES)))

    return scored(text_of(text))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and its score, 0 to 1.

    Whole texts are scored; a null text counts as empty and gets what wordless texts get. Without a model (no labels) the
    score is 0. Rows are independent of each other and of other columns; null and repeated ids change nothing. An empty
    table gives no rows.
    """
    short_batches(docs.sparkSession)
    score = F.lit(0.0) if model is None else toxicity_score(model, text)
    return docs.select(F.col(key).alias("doc_id"), score.alias("score"))
