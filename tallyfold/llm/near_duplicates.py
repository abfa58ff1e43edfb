"""Near-duplicate documents by DartMinHash.

Method: the shingles (five words) of a text are weighted elements. Darts are thrown by a random
process that depends only on the element: in the strip of an element they arrive in order of rank,
``t`` per unit of rank and weight; a dart inside the element's weight counts, and names one of ``t``
coordinates. Per coordinate the dart of lowest rank is kept, so two texts agree in a coordinate with
a probability equal to their weighted Jaccard similarity. Only ranks below about (ln t + 2) / total
weight are thrown, which is t * (ln t + 2) darts a text however long it is; if a coordinate stays
empty the bound is doubled. Signatures are cut into bands of ``rows`` coordinates and joined on them.

Links are texts with an exact Jaccard similarity of ``threshold`` or more; classes are what links
connect. With 36 bands of 7 a pair at 0.8 shares a band with probability 0.9998.

No group is turned into all its pairs. Copies are one text. In a band each text is compared to the
head of the band only, a text that shares many bands. Texts of one band that are in different classes
after that may still be linked through another text: those outside the largest class are compared
with all of the band, in blocks that return links, not pairs. So no pair that shares a band is left
out unless its texts are in one class already.

Defined results: words are what white space parts, in lower case; a text of fewer than five words is
one shingle; texts without words (and NULL) are copies of each other; documents without an id take
part, the class id is the smallest id of the class, NULL if none has one; repeated rows are copies.
Other columns are ignored.

At scale: signatures and words are made in Python on Arrow batches, one text at a time, so a long
text costs its own size. Bands are counted with partial sums, and joined where Spark splits hot
bands. Shingles are moved only for texts that share a band. Classes are found by rounds of joins on
edges, written to the shared folder in every round; a star around its first text takes two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.sources.shared import stored

BANDS = 36
ROWS = 7
SHINGLE = 5
BLOCK = 200_000  # shingles of one side of a block
THRESHOLD = 0.8

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word met so far; emptied when it holds a million, so memory stays bounded."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of a text as sorted 64-bit hashes, and how often each occurs."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - size + 1)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(size, len(ids))):
            grams = mixed_bits(grams + ids[j : j + n] + _GOLDEN)
    return np.unique(grams, return_counts=True)


def _pieces(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Strips of the elements, cut at weights 1, 2, 4, ...: stream of darts, low, high, weight."""
    found, level, low, high = [], 0, 0.0, 1.0
    while (held := weights > low).any():
        n = int(held.sum())
        stream = mixed_bits(elements[held] + np.uint64(level + 1) * _GOLDEN)
        found.append((stream, np.full(n, low), np.full(n, high), weights[held].astype(float)))
        level, low, high = level + 1, high, high * 2
    return tuple(np.concatenate(part) for part in zip(*found))


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _thrown(strips: tuple[np.ndarray, ...], t: int, bound: float) -> tuple[np.ndarray, ...]:
    """All darts below a rank that lie inside their element: coordinate, rank, identity."""
    stream, low, high, top = strips
    rank, number, hits = np.zeros(len(stream)), np.zeros(len(stream), np.uint64), []
    while len(stream):
        mean = float(((bound - rank) * t * (high - low)).mean())
        step = np.arange(1, int(mean + 3 * np.sqrt(mean)) + 3, dtype=np.uint64)
        darts = mixed_bits(stream[:, None] + (number[:, None] + step) * _GOLDEN)
        ranks = rank[:, None] + np.cumsum(-np.log(_unit(darts)), axis=1) / (t * (high - low))[:, None]
        near = ranks < bound
        row, _ = np.nonzero(near)
        darts_in, ranks_in = darts[near], ranks[near]
        other = mixed_bits(darts_in ^ _GOLDEN)
        inside = low[row] + (high - low)[row] * _unit(other) < top[row]
        hits.append(((other[inside] % np.uint64(t)).astype(np.int64), ranks_in[inside], darts_in[inside]))
        more = near[:, -1]
        rank, number = ranks[more, -1], number[more] + np.uint64(len(step))
        stream, low, high, top = stream[more], low[more], high[more], top[more]
    return tuple(np.concatenate(part) for part in zip(*hits))


def dart_minhash(elements: np.ndarray, weights: np.ndarray, t: int) -> np.ndarray:
    """Per coordinate the identity of the first dart that lies in the set; zeros for an empty set.

    The weight of an element is cut into strips; each has its own stream of darts, and a dart is at
    a random height of its strip. Streams do not depend on the weight, so two sets throw the same
    darts where they overlap.
    """
    names = np.zeros(t, np.uint64)
    if not len(elements):
        return names
    with np.errstate(over="ignore"):
        strips, bound = _pieces(elements, weights), (np.log(t) + 2) / float(weights.sum())
        while True:
            at, rank, dart = _thrown(strips, t, bound)
            least = np.full(t, np.inf)
            np.minimum.at(least, at, rank)
            if np.isfinite(least).all():
                first = rank == least[at]
                names[at[first]] = dart[first]
                return names
            bound *= 2


def band_keys(names: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the number of the band is part of it."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in names.reshape(bands, rows).T:
            keys = mixed_bits(keys + column + _GOLDEN)
    return keys.view(np.int64)


def _arrays(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def _signed(bands: int, rows: int, weighted: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys = []
                for text in part.column("text"):
                    elements, counts = shingles(text.as_py(), hashes)
                    weights = counts if weighted else np.ones(len(counts))
                    # Texts without shingles are alike; they share one band of their own.
                    named = dart_minhash(elements, weights, bands * rows) if len(elements) else None
                    keys.append(np.zeros(1, np.int64) if named is None else band_keys(named, bands, rows))
                yield pa.RecordBatch.from_arrays([part.column("node"), _arrays(keys)], ["node", "keys"])

    return work


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            found = [shingles(text.as_py(), hashes) for text in part.column("text")]
            elements = _arrays([x[0].view(np.int64) for x in found])
            counts = _arrays([x[1] for x in found])
            yield pa.RecordBatch.from_arrays([part.column("node"), elements, counts], ["node", "elements", "counts"])


_NODE = "unhex(md5(encode(coalesce(text, ''), 'UTF-8'))) as node"


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is high enough."""
    left = pairs.join(sets.selectExpr("node as a", "elements as ea"), "a")
    both = left.join(sets.selectExpr("node as b", "elements as eb"), "b")
    common = "size(array_intersect(ea, eb))"
    return both.filter(f"{common} >= {threshold}D * (size(ea) + size(eb) - {common}) - 1e-9D").select("a", "b")


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.expr("count(*)"), F.expr("sum(cast(xxhash64(u, v) as decimal(20, 0)))")).first())


def components(edges: DataFrame, nodes: str = "a", others: str = "b") -> DataFrame:
    """(node, root): every node that has an edge, with the smallest node it is connected to.

    Alternates the two star contractions: larger neighbours of a node are tied to its smallest
    neighbour, then smaller ones. Every round is written, so a lost executor costs one round.
    """
    current = stored(edges.selectExpr(f"{nodes} as u", f"{others} as v").filter("u <> v").distinct(), "component-edges")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.selectExpr("v as u", "u as v"))
        smallest = both.groupBy("u").agg(F.expr("min(least(u, v)) as m"))
        large = both.filter("v > u").join(smallest, "u").selectExpr("v as u", "m as v").filter("u <> v").distinct()
        # Now v < u: tie each smaller neighbour, and u itself, to the smallest of them.
        floor = large.groupBy("u").agg(F.expr("min(v) as m"))
        small = large.join(floor, "u").selectExpr("inline(array(struct(v as u, m as v), struct(u as u, m as v)))")
        current, before = stored(small.filter("u <> v").distinct(), "component-edges"), state
        state = _state(current)
        if state == before:
            break
    roots = current.selectExpr("v as node", "v as root").distinct()
    return current.selectExpr("u as node", "v as root").unionByName(roots)


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """Classes after further links: the roots that those connect get a root of their own."""
    left, right = found.selectExpr("node as a", "root as ra"), found.selectExpr("node as b", "root as rb")
    between = more.join(left, "a", "left").join(right, "b", "left").selectExpr("coalesce(ra, a) as ra", "coalesce(rb, b) as rb")
    second = components(between, "ra", "rb").selectExpr("node as mid", "root as last")
    alone = second.selectExpr("mid as node", "mid as root").join(found, "node", "left_anti")
    tied = found.unionByName(alone).join(second, F.expr("root = mid"), "left")
    return tied.selectExpr("node", "coalesce(last, root) as root")


def _with_heads(members: DataFrame) -> DataFrame:
    """Members of the bands (key, node, n texts in the band) with the head of each band.

    The head is the text that shares most: the sum of n over its bands is largest. Among many edits
    of one text that is one with few edits, to which most others are similar.
    """
    members = stored(members, "dart-members")
    central = members.groupBy("node").agg(F.expr("sum(n) as shares"))
    placed = members.join(central, "node")
    heads = placed.groupBy("key").agg(F.expr("max(struct(shares, node)).node as head"))
    return members.join(heads, "key").select("key", "node", "head")


def _open_bands(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the bands that still hold more than one class."""
    at = members.join(found, "node", "left").selectExpr("key", "node", "head", "coalesce(root, node) as root")
    spread = at.groupBy("key").agg(F.expr("min(root) as one"), F.expr("max(root) as two")).filter("one <> two")
    return stored(at.join(spread.select("key"), "key", "left_semi"), "dart-open-bands")


def _compared(threshold: float):
    """Links between the query texts and the others of one block, one for each two classes at most per text."""

    def work(block: pa.Table) -> pa.Table:
        nodes, roots = block.column("node").to_pylist(), np.array(block.column("root").to_pylist(), object)
        asks = block.column("asks").to_numpy()
        sets = [np.asarray(x.values) for x in block.column("elements")]
        mine, other = np.nonzero(asks)[0], np.nonzero(~asks)[0]
        links: list[tuple[bytes, bytes]] = []
        if len(mine) and len(other):
            known = np.unique(np.concatenate([sets[i] for i in mine]))
            sizes = np.array([len(sets[i]) for i in other])
            elements = np.concatenate([sets[i] for i in other])
            at = np.searchsorted(known, elements)
            at[at == len(known)] = 0
            present = known[at] == elements if len(known) else np.zeros(len(elements), bool)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for i in mine:
                flags = np.zeros(len(known), bool)
                flags[np.searchsorted(known, sets[i])] = True
                sums = np.concatenate([[0], np.cumsum(flags[at] & present)])
                common = sums[ends[1:]] - sums[ends[:-1]]
                linked = other[common >= threshold * (len(sets[i]) + sizes - common) - 1e-9]
                linked = linked[roots[linked] != roots[i]]
                first = {roots[j]: j for j in linked[::-1]}
                links += [tuple(sorted((nodes[i], nodes[j]))) for j in first.values()]
        return pa.table({"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())})

    return work


def _links_between_classes(apart: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between texts of a band that are in different classes.

    The texts outside the largest class of the band are a query set against all of the band. Both
    sides are dealt into chunks of about ``BLOCK`` shingles, and every chunk of one meets every chunk
    of the other; a link is returned, never a pair.
    """
    sized = stored(apart.join(sets, "node").selectExpr("key", "node", "root", "elements", "size(elements) as n"), "dart-open-sets")
    by_class = sized.groupBy("key", "root").agg(F.expr("count(*) as texts"), F.expr("sum(n) as n"))
    shape = by_class.groupBy("key").agg(F.expr("max(struct(texts, root, n)) as most"), F.expr("sum(n) as n"))
    shape = shape.selectExpr("key", "most.root as most", f"int(ceil(n / {BLOCK})) as n_all", f"int(greatest(1, ceil((n - most.n) / {BLOCK}))) as n_ask")
    told = sized.drop("n").join(shape, "key")
    others = told.selectExpr("key", "node", "root", "elements", "false as asks", "int(pmod(xxhash64(node), n_all)) as y", "explode(sequence(0, n_ask - 1)) as x")
    asking = told.filter("root <> most").selectExpr("key", "node", "root", "elements", "true as asks", "int(pmod(xxhash64(node), n_ask)) as x", "explode(sequence(0, n_all - 1)) as y")
    blocks = others.unionByName(asking).groupBy("key", "x", "y")
    return blocks.applyInArrow(_compared(threshold), "a binary, b binary").distinct()


def classes(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, threshold: float = THRESHOLD, weighted: bool = False
) -> DataFrame:
    """One row per document: its text's node, and the id and first node of its class.

    ``weighted`` takes the number of times a shingle occurs as its weight; by default a shingle
    weighs 1 and the similarity is that of sets.
    """
    texts = docs.selectExpr(_NODE, "text")
    # A copy of a text has the same signature; one is kept per text.
    signed = texts.mapInArrow(_signed(bands, rows, weighted), "node binary, keys array<bigint>")
    signed = stored(signed.groupBy("node").agg(F.expr("first(keys) as keys")), "dart-signatures")
    banded = signed.selectExpr("node", "explode(keys) as key")
    sizes = banded.groupBy("key").agg(F.expr("count(*) as n")).filter("n > 1")
    members = stored(_with_heads(banded.join(sizes, "key")), "dart-bands")

    wanted = members.select("node").distinct()
    candidates = texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.expr("first(text) as text"))
    sets = candidates.mapInArrow(_shingled, "node binary, elements array<bigint>, counts array<bigint>")
    # Weighted: repeats of a shingle are numbered, so that the multiset becomes a set.
    repeats = "flatten(transform(elements, (x, i) -> transform(sequence(1, int(counts[i])), n -> xxhash64(x, n)))) as elements"
    sets = stored(sets.selectExpr("node", repeats if weighted else "elements"), "dart-shingles")

    stars = members.filter("node <> head").selectExpr("least(head, node) as a", "greatest(head, node) as b").distinct()
    links = stored(_similar(stars, sets, threshold), "dart-links")
    found = components(links)

    more = stored(_links_between_classes(_open_bands(members, found), sets, threshold), "dart-links")
    final = found if more.isEmpty() else stored(_merged(found, more), "dart-classes")

    rows_of = docs.selectExpr("doc_id", _NODE)
    placed = rows_of.join(final, "node", "left").selectExpr("doc_id", "node", "coalesce(root, node) as root")
    firsts = placed.groupBy("root").agg(
        F.expr("min(doc_id) as class_id"), F.expr("min(struct(doc_id is null, doc_id, node)).node as first_node"), F.expr("count(*) as class_size")
    )
    return placed.join(firsts, "root").select("doc_id", "class_id", "class_size", "node", "first_node")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class: that of the smallest id, rows alike taken once."""
    kept = classes(docs, **options).filter("doc_id <=> class_id and node = first_node").select("doc_id", "node").distinct()
    kept = kept.withColumnsRenamed({"doc_id": "_id", "node": "_node"})
    named = docs.withColumn("_text_node", F.expr(_NODE.removesuffix(" as node")))
    chosen = named.join(kept, named["doc_id"].eqNullSafe(kept["_id"]) & (named["_text_node"] == kept["_node"]))
    return chosen.dropDuplicates(["_id", "_node"]).select(*[named[name] for name in docs.columns])
