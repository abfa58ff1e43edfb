"""Cross-entropy difference of two n-gram models.

Method: a target model is trained on chosen documents, a background model on all documents. They are
matched: one order (bigrams backed by unigrams with a Dirichlet prior, those by a base probability of
1 / V for each of the V different words of all documents, the vocabulary both share), and background
counts scaled to the size of the target, so both are equally smooth. In either model the words of the
vocabulary have probabilities that add up to 1, after any word. The score of a document is the mean
over its words of the target's loss less the background's, in nats: negative for a document nearer
to the target.

Counts grow with the corpus: one for each different word and each different pair of neighbours, told
apart by 64-bit hashes. Of n different keys about n * n / 2^65 share a count with another: one at six
billion.

Defined results: words are what white space parts, in lower case; a document without words (or with
a NULL text) has 0 words and a NULL score; without target documents all scores are 0; a label counts
for every document with its id, a repeated label once; documents without an id are never targets;
repeated rows count each time and each get a row. Other columns are ignored. ``docs`` should come
from a table: rows of one large id are dealt by their places in it, which must not change when an
executor is lost.

At scale: documents are dealt by a hash of their ids into blocks of about ``BLOCK`` characters, at
least ``MIN_BLOCKS``; the rows of an id that has more than that are spread over several blocks, rows
without an id over all. A block asks once for each of its different words and pairs, with its own
counts. These are dealt by ranges of their hashes into as many buckets, a list for each, where the
counts of all blocks are added up; the sums go back to the block, which scores its documents with
them. So the model is never in one place: a task holds the part that one block or bucket needs, and a
key has at most one entry a block, however frequent it is. A list is little more than its bytes and
none is empty: however many blocks there are, lists cost about a row for each key of a block at most.
Texts are moved once, for both passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.near_duplicates import mixed_bits
from tallyfold.sources.shared import stored

PRIOR = 50.0
BLOCK = 12_000_000
MIN_BLOCKS = 16
MET = 1_000_000  # words told apart before they are passed on to be counted

_TOTAL = np.zeros(1, np.uint64)  # key of all words


def _hashes(words) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) for word in words], np.uint64)


class Numbers(dict):
    """Number of each word, in the order they are met."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


class Block:
    """Words and pairs of some texts as numbers, and their keys in an order that does not depend on that of the texts."""

    def __init__(self, texts: pa.ChunkedArray):
        numbers, parts = Numbers(), []
        for text in texts:
            words = (text.as_py() or "").lower().split()
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.different = len(numbers)
        self.sizes = np.array([len(part) for part in parts], np.int64)
        self.words = np.concatenate([*parts, np.empty(0, np.int64)])
        # Whose words they are; a pair belongs to its second word, so the first of a text has none.
        self.owner = np.repeat(np.arange(len(parts)), self.sizes)
        self.second = np.flatnonzero(np.diff(self.owner, prepend=-1) == 0)
        codes = self.words[self.second - 1] * max(1, len(numbers)) + self.words[self.second]
        codes, self.pairs = np.unique(codes, return_inverse=True)
        self.before, self.after = np.divmod(codes, max(1, len(numbers)))
        singles = _hashes(numbers)
        with np.errstate(over="ignore"):
            keys = np.concatenate([_TOTAL, singles, mixed_bits(mixed_bits(singles[self.before]) + singles[self.after])])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def dealt(self, buckets: int) -> list[tuple[int, slice]]:
        """Parts of the sorted keys that lie in each bucket, an equal range of hashes."""
        number = ((self.keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        found, starts = np.unique(number, return_index=True)
        return [(int(bucket), slice(a, b)) for bucket, a, b in zip(found, starts, [*starts[1:], len(number)])]

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """How often each key occurs, in all texts or in the chosen ones: all words, each word, each pair."""
        words, pairs = self.words, self.pairs
        if chosen is not None:
            words, pairs = words[chosen[self.owner]], pairs[chosen[self.owner[self.second]]]
        found = [np.bincount(words, minlength=self.different), np.bincount(pairs, minlength=len(self.before))]
        return np.concatenate([[len(words)], *found]).astype(np.int64)


_MET = pa.schema([("word", pa.int64()), ("size", pa.int64())])
_ASKED = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("every", pa.binary()), ("target", pa.binary())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.float64(): "double"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the different words that a task meets, and its number of characters without a word."""
    words, size = set(), 0
    for batch in batches:
        for text in batch.column("text"):
            whole = text.as_py() or ""
            size += len(whole)
            words.update(whole.lower().split())
            if len(words) > MET:
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(words).view(np.int64)), pa.array(np.zeros(len(words), np.int64))], schema=_MET)
                words.clear()
    yield pa.RecordBatch.from_arrays([pa.array([*_hashes(words).view(np.int64).tolist(), None], pa.int64()), pa.array([*[0] * len(words), size], pa.int64())], schema=_MET)


def vocabulary(texts: DataFrame) -> tuple[int, int]:
    """Number of different words of all texts, and of their characters."""
    words = texts.select("text").mapInArrow(_met, _ddl(_MET)).groupBy("word").agg(F.expr("sum(size) as size"))
    return tuple(words.agg(F.expr("count(word)"), F.expr("coalesce(sum(size), 0L)")).first())


def _packed_keys(keys: np.ndarray) -> bytes:
    """Steps between sorted keys, all their first bytes, then all second ones: the high ones are zeros, which a shuffle compresses."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked_keys(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest, compressed after that number of bytes."""
    kind = np.min_scalar_type(int(counts.max()))
    return bytes([kind.itemsize]) + pa.compress(counts.astype(kind).tobytes(), "zstd", asbytes=True)


def _unpacked_counts(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data[1:], n * data[0], "zstd", asbytes=True)
    return np.frombuffer(raw, f"u{data[0]}").astype(np.int64)


def _lists(block: list[int], bucket: list[int], *columns: list[bytes]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(block, pa.int32()), pa.array(bucket, pa.int32()), *[pa.array(column, pa.binary()) for column in columns]], schema=_ASKED)


def _asked(number: int, buckets: int, docs: pa.Table, targets: pa.Table) -> pa.Table:
    """Different keys of a block with its own counts, a list for each bucket."""
    if not docs.num_rows:
        return _ASKED.empty_table()
    block = Block(docs.column("text"))
    # A NULL id is in no list of ids.
    chosen = pc.is_in(docs.column("doc_id"), value_set=targets.column("doc_id").combine_chunks(), skip_nulls=True).to_numpy()
    every, target = block.counts()[block.order], block.counts(chosen)[block.order]
    parts = block.dealt(buckets)
    keys = [_packed_keys(block.keys[part]) for _, part in parts]
    counts = [[_packed_counts(column[part]) for _, part in parts] for column in (every, target)]
    return _lists([number] * len(parts), [bucket for bucket, _ in parts], keys, *counts)


def _summed(lists: pa.Table) -> pa.Table:
    """For each list of a bucket the sums over all lists, in the order of its keys; the keys do not go back."""
    keys = [_unpacked_keys(data) for data in lists.column("keys").to_pylist()]
    sizes = [len(part) for part in keys]
    different, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends, answers = np.cumsum(sizes)[:-1], []
    for name in ("every", "target"):
        total = np.zeros(len(different), np.int64)
        np.add.at(total, at, np.concatenate([_unpacked_counts(data, n) for data, n in zip(lists.column(name).to_pylist(), sizes)]))
        answers.append([_packed_counts(part) for part in np.split(total[at], ends)])
    return _lists(lists.column("block").to_pylist(), lists.column("bucket").to_pylist(), [b""] * len(sizes), *answers)


def losses(block: Block, model: np.ndarray, base: float, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """Loss in nats of each word at the start of a text, and of the second word of each pair."""
    total, own, pairs = model[0], model[1 : 1 + block.different], model[1 + block.different :]
    single = (own + prior * base) / (total + prior)
    return -np.log(single), -np.log((pairs + prior * single[block.after]) / (own[block.before] + prior))


def _scored(buckets: int, base: float, docs: pa.Table, sums: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _SCORED.empty_table()
    block = Block(docs.column("text"))
    every, target = np.zeros((2, len(block.keys)))
    row_of = {bucket: row for row, bucket in enumerate(sums.column("bucket").to_pylist())}
    for bucket, part in block.dealt(buckets):
        for model, name in ((every, "every"), (target, "target")):
            model[block.order[part]] = _unpacked_counts(sums.column(name)[row_of[bucket]].as_py(), part.stop - part.start)
    if every[0]:
        every *= target[0] / every[0]
    starts, pairs = (of_target - of_all for of_target, of_all in zip(losses(block, target, base), losses(block, every, base)))
    gaps = starts[block.words]
    gaps[block.second] = pairs[block.pairs]
    added = np.bincount(block.owner, gaps, len(block.sizes))
    scores = pa.array(added / np.maximum(1, block.sizes), mask=block.sizes == 0)
    return pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), pa.array(block.sizes), scores], schema=_SCORED)


def large_ids(docs: DataFrame, block_size: int) -> DataFrame:
    """Ids whose texts fill more than one block, and how many: one row at most for every ``block_size`` characters of all texts."""
    sizes = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.expr("sum(length(text)) as size"))
    return sizes.filter(f"size > {block_size}").selectExpr("doc_id as large", f"bigint(ceil(size / {block_size})) as parts")


def dealt_documents(docs: DataFrame, large: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, text, block): by the id, by the place of the row as well for a large id, and by that alone without an id."""
    placed = docs.selectExpr("doc_id", "text", "monotonically_increasing_id() as place")
    joined = placed.join(F.broadcast(large), F.expr("doc_id = large"), "left")
    own = f"pmod(pmod(xxhash64(doc_id), {blocks}) + pmod(place, coalesce(parts, 1L)), {blocks})"
    return joined.selectExpr("doc_id", "text", f"int(if(doc_id is null, pmod(xxhash64(place), {blocks}), {own})) as block")


def dealt_targets(ids: DataFrame, large: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, block): every id in each block that has rows of it."""
    joined = ids.join(F.broadcast(large), F.expr("doc_id = large"), "left")
    spread = joined.selectExpr("doc_id", "explode(sequence(0L, coalesce(parts, 1L) - 1L)) as part")
    return spread.selectExpr("doc_id", f"int(pmod(pmod(xxhash64(doc_id), {blocks}) + part, {blocks})) as block")


def entropy_difference(docs: DataFrame, target_ids: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """One row per document: words, and the target's mean loss less the background's."""
    narrow = docs.selectExpr("bigint(doc_id) as doc_id", "text")
    words, size = vocabulary(narrow)
    blocks, base = max(MIN_BLOCKS, -(-size // block_size)), 1 / max(1, words)
    large = stored(large_ids(narrow, block_size), "entropy-large-ids")
    dealt = dealt_documents(narrow, large, blocks).groupBy("block")
    ids = target_ids.selectExpr("bigint(doc_id) as doc_id").filter("doc_id is not null").distinct()
    targets = dealt_targets(ids, large, blocks).groupBy("block")
    asked = dealt.cogroup(targets).applyInArrow(lambda key, left, right: _asked(key[0].as_py(), blocks, left, right), _ddl(_ASKED))
    sums = asked.groupBy("bucket").applyInArrow(_summed, _ddl(_ASKED)).groupBy("block")
    return dealt.cogroup(sums).applyInArrow(lambda left, right: _scored(blocks, base, left, right), _ddl(_SCORED))
