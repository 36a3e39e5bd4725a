"""N-gram Jaccard self-join: Bayesian pruning of MinHash candidates, then exact verification.

1. Texts with equal shingle sets form one class; only classes go on.
2. Bands of MinHash values put classes into buckets. Within a bucket, pairs compare their values a few at a time and
   are dropped once the posterior probability that they reach the threshold falls below a tolerance. What is left
   connects the classes of a bucket; a spanning forest of it suffices, so no task emits pairs.
3. Connected classes meet in blocks; each pair of a block goes through the same pruning and, if it survives, is
   verified exactly on the whole shingle sets, which travel as differences from one set of their component. Blocks return
   each class's number of links and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, quoted, short_batches, small, text_of, unused
from orderpulse.llm.components import components
from orderpulse.llm.words import mix, shingle_set, whole_groups


@dataclass(frozen=True)
class JoinSettings:
    """Words in a shingle, the least similarity, bands and values in a band, values compared at a time, the tolerance of
    pruning, and how many classes of a bucket or a component a task compares at once (`tile`, `block`): larger
    ones are split into pairs of tiles, which loses none of their pairs.

    A pair of similarity 0.8 misses all bands with probability 6e-7.
    """

    width: int = 5
    threshold: float = 0.8
    bands: int = 20
    rows: int = 3
    step: int = 10
    tolerance: float = 1e-6
    tile: int = 16_384
    block: int = 512

    @property
    def values(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """(values compared, matches needed): with fewer, P(similarity >= threshold) is below the tolerance.

        The prior is uniform. After m of n matches the posterior is Beta(m + 1, n - m + 1), and its tail above t is
        the chance of at most m successes in n + 1 trials of probability t.
        """
        t, out = self.threshold, []
        for n in range(self.step, self.values + 1, self.step):
            tail, m = 0.0, -1
            while tail < self.tolerance:
                m += 1
                tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out


def minhash(shingles: np.ndarray, values: int) -> np.ndarray:
    """The least of each of `values` hash functions over the shingles."""
    n = np.arange(1, values + 1, dtype=np.uint64)
    scale, shift = mix(n) | np.uint64(1), mix(n + np.uint64(1 << 32))
    least = np.full(values, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2_048):
        least = np.minimum(least, (shingles[at:at + 2_048, None] * scale + shift).min(0))
    return mix(least)


SKETCH = "doc_id long, text_hash long, node long, signature binary, bands array<long>"


def sketch(docs: DataFrame, settings: JoinSettings, key: str, text: str) -> DataFrame:
    """Per document: `node`, a hash of its shingle set (null without words), 16 bits of each MinHash value, and band keys."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"),
                       text_of(text).alias("text"))

    def sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = mix(np.arange(settings.bands, dtype=np.uint64))
        for batch in batches:
            nodes, signatures, bands = [], [], []
            for body in batch["text"]:
                shingles = shingle_set(body, settings.width)
                if not len(shingles):
                    nodes.append(None), signatures.append(None), bands.append(None)
                    continue
                least = minhash(shingles, settings.values)
                key_of_band = salt.copy()
                for column in least.reshape(settings.bands, settings.rows).T:
                    key_of_band = mix(key_of_band * np.uint64(31) + column)
                nodes.append(int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)))
                signatures.append((least & np.uint64(0xFFFF)).astype("<u2").tobytes())
                bands.append(key_of_band.astype(np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "node": pd.array(nodes, "Int64"),
                                "signature": pd.Series(signatures, dtype=object, index=batch.index),
                                "bands": pd.Series(bands, dtype=object, index=batch.index)})

    return rows.mapInPandas(sketches, SKETCH)


def survivors(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the rows of `left` and `right` whose pair is not dropped at any step."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int16), 0
    for n, least in needed:
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(1, dtype=np.int16)
        on = matches >= least
        alive, matches, done = alive[on], matches[on], n
    return alive


def forest(neighbours, count: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest; `neighbours(n, others)` tells which of `others` are linked with `n`."""
    edges, open_nodes = [], np.arange(count)
    while len(open_nodes):
        todo, open_nodes = [int(open_nodes[0])], open_nodes[1:]
        while todo and len(open_nodes):
            n = todo.pop()
            linked = neighbours(n, open_nodes)
            found = open_nodes[linked]
            edges += [(n, int(x)) for x in found]
            todo += found.tolist()
            open_nodes = np.delete(open_nodes, linked)
    return edges


EDGES = "a long, b long"


def bucket_links(buckets: DataFrame, settings: JoinSettings) -> DataFrame:
    """A spanning forest over what pruning leaves of each bucket; buckets have (bucket, low, high, node, signature)."""
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        needed = settings.least_matches()
        for frame, starts in whole_groups(batches, ["bucket", "low", "high"]):
            nodes = frame["node"].to_numpy()
            values = np.frombuffer(b"".join(frame["signature"]), "<u2").reshape(len(frame), settings.values)
            sizes = np.diff(starts)
            first = np.repeat(starts[:-1], sizes)
            others = np.flatnonzero(first != np.arange(len(frame)))
            alive = others[survivors(values[first[others]], values[others], needed)]
            a, b = [nodes[first[alive]]], [nodes[alive]]
            # A bucket whose rows all stand by its first one is connected; the others are searched through.
            linked = np.bincount(np.searchsorted(starts, alive, "right") - 1, minlength=len(sizes))
            for n in np.flatnonzero(linked < sizes - 1):
                own = values[starts[n]:starts[n + 1]]
                found = forest(lambda x, rest, own=own: survivors(
                    np.broadcast_to(own[x], (len(rest), own.shape[1])), own[rest], needed), len(own))
                if found:
                    pairs = np.array(found) + starts[n]
                    a.append(nodes[pairs[:, 0]])
                    b.append(nodes[pairs[:, 1]])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    keys = ["bucket", "low", "high"]
    return buckets.repartition(*keys).sortWithinPartitions(*keys, "node").mapInPandas(links, EDGES)


def in_tiles(rows: DataFrame, count: str, tile: int, node: str = "node") -> DataFrame:
    """Each row once for each pair of tiles (`low` <= `high`) that it is in; `count` rows make ceil(count / tile) tiles."""
    tiles = F.ceil(F.col(count) / tile)
    own = F.pmod(F.xxhash64(node, F.lit("tile")), tiles)
    return (
        rows.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .withColumn("low", F.least("__own", "__other")).withColumn("high", F.greatest("__own", "__other"))
        .withColumn("tile", F.col("__own")).drop("__own", "__other"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, as products of 0/1 matrices over the shingles that occur twice."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    owner, column = owner[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(shared.sum()), 4_096):
        low, high = np.searchsorted(column, [at, at + 4_096])
        part = np.zeros((len(sets), 4_096), np.float32)
        part[owner[low:high], column[low:high] - at] = 1
        total += part @ part.T
    return total


LINKS = "a long, b long, links long"


def block_links(blocks: DataFrame, settings: JoinSettings) -> DataFrame:
    """Verified links of each block (root, low, high, tile, node, copies, signature, n_shingles, delta).

    Pairs that survive pruning are checked exactly, from what each set has other than their component's base. Rows (a, b)
    are a spanning forest, rows (a, null, links) numbers of linked documents.
    """
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        needed = settings.least_matches()
        for frame, starts in whole_groups(batches, ["root", "low", "high"]):
            out = []
            for low, high in zip(starts[:-1], starts[1:], strict=True):
                rows = frame.iloc[low:high].drop_duplicates("node")
                values = np.frombuffer(b"".join(rows["signature"]), "<u2").reshape(len(rows), settings.values)
                i, j = np.triu_indices(len(rows), 1)
                tile = rows["tile"].to_numpy()
                if rows["low"].iloc[0] != rows["high"].iloc[0]:  # pairs within a tile belong to its own block
                    across = tile[i] != tile[j]
                    i, j = i[across], j[across]
                alive = np.concatenate([at + survivors(values[i[at:at + 65_536]], values[j[at:at + 65_536]], needed)
                                        for at in range(0, len(i), 65_536)] or [np.zeros(0, np.int64)])
                i, j = i[alive], j[alive]
                if not len(i):
                    continue
                checked = np.unique(np.concatenate([i, j]))  # the others have no pair left
                deltas = [np.frombuffer(rows["delta"].iloc[n], "<u8") for n in checked.tolist()]
                away, sizes = np.zeros(len(rows), np.int64), rows["n_shingles"].to_numpy()
                away[checked] = [len(d) for d in deltas]
                common = overlaps(deltas)[np.searchsorted(checked, i), np.searchsorted(checked, j)].astype(np.int64)
                # |A xor B| = |dA xor dB|, whatever the base is.
                both = (sizes[i] + sizes[j] - (away[i] + away[j] - 2 * common)) // 2
                real = both >= settings.threshold * (sizes[i] + sizes[j] - both) - 1e-6
                i, j = i[real], j[real]
                near = np.zeros((len(rows), len(rows)), bool)
                near[i, j] = near[j, i] = True
                nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
                counts = near @ copies
                out += [(nodes[a], nodes[b], 0) for a, b in forest(lambda n, rest, near=near: np.flatnonzero(near[n, rest]), len(rows))]
                out += [(nodes[n], None, counts[n]) for n in np.flatnonzero(counts)]
            a, b, counts = zip(*out, strict=True) if out else ((), (), ())
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": pd.array(list(b), "Int64"), "links": np.array(counts, np.int64)})

    keys = ["root", "low", "high"]
    return blocks.repartition(*keys).sortWithinPartitions(*keys, "node").mapInPandas(links, LINKS)


def shingled(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """Rows of (doc_id, text, node, ...) whose text has the shingle set `node`, with the set."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [shingle_set(body, settings.width).tobytes() for body in batch["text"]]
            batch = batch.drop(columns="text")
            batch["shingles"] = made
            same = [int(np.uint64(xxhash.xxh3_64_intdigest(s)).astype(np.int64)) == n
                    for s, n in zip(made, batch["node"], strict=True)]
            yield batch[same]

    return docs.mapInPandas(sets, f"{schema}, shingles binary")


def deltas(sets: DataFrame) -> DataFrame:
    """(root, members, node, copies, signature, n_shingles, delta): each set as its difference from that of its component's root.

    Near copies differ in few shingles, so that little travels with each pair of tiles. Any base gives the same pairs.
    """
    bases = sets.where("node = root").groupBy("root").agg(F.first("shingles").alias("base"))  # rows that repeat have equal sets
    schema = "root long, members long, node long, copies long, signature binary, n_shingles long, delta binary"

    def differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [(np.frombuffer(s, "<u8"), np.frombuffer(b, "<u8")) for s, b in zip(batch["shingles"], batch["base"], strict=True)]
            made = batch[["root", "members", "node", "copies", "signature"]].copy()
            made["n_shingles"] = [len(s) for s, _ in pairs]
            made["delta"] = [np.setxor1d(s, b, assume_unique=True).tobytes() for s, b in pairs]
            yield made

    return sets.join(bases, "root").mapInPandas(differences, schema)


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 settings: JoinSettings = JoinSettings()) -> DataFrame:
    """One row per document: doc_id, text_hash, set_id, class_id, n_links.

    `n_links` counts the other documents whose shingle sets have at least the threshold's Jaccard similarity; copies of a
    set count one by one. `set_id` is the least id among documents of the same set, `class_id` the least id among all that
    links connect. A text of fewer words than a shingle is one shingle; null and wordless texts have no links and are
    classes of their own (`class_id` their id). A null id is less than no other: it is only reported
    where a class has no other id. Ids are whole numbers (text that is none fails). Empty tables give no rows; other columns
    are not looked at. Sets count as equal when their 64-bit hashes are.
    """
    short_batches(docs.sparkSession)
    sketches = kept(sketch(docs, settings, key, text))
    classes = kept(sketches.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("set_id"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("set_hash"),
        F.count(F.lit(1)).alias("copies"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands")))

    in_bands = classes.select("node", F.explode("bands").alias("bucket"))
    shared = kept(in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    buckets = in_tiles(in_bands.join(shared, "bucket"), "members", settings.tile).drop("tile", "members")
    candidates = bucket_links(buckets.join(classes.select("node", "signature"), "node"), settings)

    grouped = kept(components(candidates))
    sizes = kept(grouped.groupBy("root").agg(F.count(F.lit(1)).alias("members")))
    wanted = kept(grouped.join(sizes, "root").join(classes.drop("bands"), "node"))
    # A class's text is found by id and hash: rows without id, or that repeat one, would else meet every class of that id.
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"), text_of(text).alias("text"))
    members = texts.alias("d").join(small(wanted, 200_000).alias("w"), F.expr("d.text_hash = w.set_hash AND d.doc_id <=> w.set_id")) \
        .select("d.text", "w.*")
    sets = kept(shingled(members, settings))
    verified = kept(block_links(in_tiles(deltas(sets), "members", settings.block), settings))

    linked = kept(components(verified.where("b IS NOT NULL").select("a", "b")))
    counts = verified.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    rooted = classes.select("node", "set_id", "copies").join(linked, "node", "left").join(counts, "node", "left").select(
        "node", "set_id", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rooted = kept(rooted)
    ids = kept(rooted.groupBy("root").agg(F.min("set_id").alias("class_id")))
    named = rooted.join(small(ids), "root").select(
        "node", "set_id", "class_id", "n_links")
    with_words = sketches.where("node IS NOT NULL").join(kept(named), "node").select(
        "doc_id", "text_hash", "set_id", "class_id", "n_links")
    return with_words.unionByName(sketches.where("node IS NULL").select(
        "doc_id", "text_hash", F.col("doc_id").alias("set_id"), F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links")))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                         settings: JoinSettings = JoinSettings()) -> DataFrame:
    """`docs`, same columns, with the row of least id of each class; rows without id stay, and so do repeats of that row.

    Null and wordless texts are classes of their own and stay. An empty table stays empty; other columns decide nothing.
    """
    one, two = unused(docs, "__id"), unused(docs, "__hash")
    gone = kept(jaccard_join(docs, key, text, settings).where("doc_id <> class_id")
                .select(F.col("doc_id").alias(one), F.col("text_hash").alias(two)).distinct())
    return docs.join(small(gone), (quoted(key).cast("long") == F.col(one)) & (F.xxhash64(text_of(text)) == F.col(two)),
                     "left_anti")
