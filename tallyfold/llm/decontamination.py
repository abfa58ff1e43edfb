"""Benchmark decontamination by winnowing.

Method: of every ``window`` neighbouring k-gram hashes of a text the smallest is kept as a
fingerprint, so any span of ``k + window - 1`` words that a document shares with a benchmark item
leaves the same fingerprint in both. Documents and items are joined on fingerprints, and each hit is
extended word by word to both sides as far as the texts agree; a hit of at least ``span`` words
counts. An item shorter than ``span`` words is one window; it gets fingerprints for its own length
(k-grams and windows that add up to it), and so do the documents, for each length that occurs.

With span 10 and k 5 a document word is hit if and only if it lies in a window of 10 words of an
item (or in the whole of a shorter one): every occurrence leaves a fingerprint inside it, the
extension by at most 9 words finds the whole occurrence, and words are compared as texts.

Defined results: words are runs of ASCII letters and digits, lower-cased, and of characters beyond
ASCII; NULL and empty texts have none and are never contaminated; an item without words finds
nothing; items with equal ids count once, items without an id mark words but are not listed;
repeated documents each get a row. Other columns are ignored.

At scale: one pass makes the fingerprints of all lengths that occur. They are narrow rows and meet those of
the benchmark in a join that Spark broadcasts only if it measures the benchmark as small. A second
pass reads texts again; a bitmap of the hashes of texts with hits (16 bits each, 16 MB at most) keeps nearly all
others out of the one exchange of texts, a merge join at every size. Its share of the corpus is that of texts with
hits. A hit carries the words around it and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import ROW, bitmap_bits, bitmap_of, in_bitmap, let, same_row
from tallyfold.sources.shared import stored

SPAN = 10
K = 5

_ROW_HASH = "xxhash64(text) as row_hash"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII texts take the faster function for the same result.
_LOWERED = f"if(octet_length(t) = length(t), lower(t), translate(t, '{_UPPER}', '{_LOWER}'))"
_PARTS = f"split({let('t', "coalesce(text, '')", _LOWERED)}, r'[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_INNER = "if(p[0] = '' or p[size(p) - 1] = '', filter(p, w -> w != ''), p)"
WORDS = let("p", _PARTS, _INNER)
N_WORDS = let(
    "p", r"split(coalesce(text, ''), r'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')", "size(p) - int(p[0] = '') - int(size(p) > 1 and p[size(p) - 1] = '')"
)


def _fingerprints(words: str, k: int, window: int) -> str:
    """SQL text of the array of (position, hash) that winnowing keeps; none for fewer than k words.

    A gram is kept if it is the smallest of some window it lies in: that is, if the largest of
    those windows' minima is its own hash. Equal smallest hashes are all kept. A text with fewer
    grams than the window has one window.
    """
    gram = ", ".join(f"ws[i + {j}]" if j else "ws[i]" for j in range(k))
    grams = f"transform(sequence(0, size(ws) - {k}), i -> xxhash64({gram}))"
    pairs = "transform({0}, p -> struct(p as pos, hs[p] as fingerprint))"
    if window == 1:
        kept = pairs.format("sequence(0, size(hs) - 1)")
    else:
        least = ", ".join(f"hs[i + {j}]" if j else "hs[i]" for j in range(window))
        minima = f"if(size(hs) < {window}, array(array_min(hs)), transform(sequence(0, size(hs) - {window}), i -> least({least})))"
        largest = ", ".join(f"get(ms, p - {j})" if j else "get(ms, p)" for j in range(window))
        kept = let("ms", minima, pairs.format(f"filter(sequence(0, size(hs) - 1), p -> hs[p] = greatest({largest}))"))
    none = "cast(array() as array<struct<pos: int, fingerprint: bigint>>)"
    return let("ws", words, f"if(size(ws) < {k}, {none}, {let('hs', grams, kept)})")


def _context(words: str) -> str:
    """SQL text of the words around a gram of ``k`` words at ``pos``, ``reach`` on each side, and how many stand before it."""
    start = "greatest(0, pos - reach)"
    return f"struct(slice({words}, {start} + 1, pos - {start} + k + reach) as words, pos - {start} as before)"


def _run(direction: str) -> str:
    """SQL text: how many words agree on one side of a common gram, ``reach`` at most."""
    d, i = ("doc", "item")
    test = {
        "left": f"x > least({d}.before, {i}.before) or {d}.words[{d}.before - x] != {i}.words[{i}.before - x]",
        "right": (
            f"{d}.before + k + x > size({d}.words) or {i}.before + k + x > size({i}.words)"
            f" or {d}.words[{d}.before + k + x - 1] != {i}.words[{i}.before + k + x - 1]"
        ),
    }[direction]
    return f"if(reach = 0, 0, coalesce(array_min(filter(sequence(1, greatest(reach, 1)), x -> {test})) - 1, reach))"


def _lengths(items: DataFrame, span: int) -> list[int]:
    """Lengths of windows that occur: ``span`` and those of shorter items, so ``span`` numbers at most."""
    found = items.selectExpr(f"least(n_words, {span}) as n").filter("n > 0").distinct().collect()
    return sorted(row.n for row in found)


def _grams(length: int, k: int) -> int:
    return min(k, length)


def _all_fingerprints(words: str, lengths: list[int], k: int, only: str = "true") -> str:
    """SQL text of the array of (length, pos, fingerprint) for all lengths that pass the test ``only`` of ``length``."""
    parts = []
    for length in lengths:
        prints = _fingerprints("words", _grams(length, k), length - _grams(length, k) + 1)
        each = f"transform({prints}, f -> struct({length} as length, f.pos as pos, f.fingerprint as fingerprint))"
        none = "cast(array() as array<struct<length: int, pos: int, fingerprint: bigint>>)"
        parts.append(each if only == "true" else f"if({only.format(length=length)}, {each}, {none})")
    return let("words", words, f"concat({', '.join(parts)})")


def matches(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """Common spans: document row, item, first word and end (exclusive) in the document."""
    items = stored(benchmark.selectExpr("item_id", f"{WORDS} as words").selectExpr("*", "size(words) as n_words"), "benchmark-words")
    lengths = _lengths(items, span)
    if not lengths:
        return docs.selectExpr("doc_id", _ROW_HASH, "cast(null as bigint) as item_id", "0 as first", "0 as end").filter("false")
    shape = [f"least(length, {k}) as k", f"length - least(length, {k}) as reach"]
    own = _all_fingerprints("words", lengths, k, f"least(n_words, {span}) = {{length}}")
    chosen = items.selectExpr("item_id", "words", f"inline({own})").selectExpr("*", *shape)
    chosen = stored(chosen.selectExpr("item_id", "length", "fingerprint", f"{_context('words')} as item"), "benchmark-fingerprints")
    wanted = chosen.selectExpr("length as _length", "fingerprint as _fingerprint").distinct()
    # Outer, since otherwise a filter is inferred that makes the fingerprints twice more.
    found = docs.selectExpr("doc_id", _ROW_HASH, f"inline_outer({_all_fingerprints(WORDS, lengths, k)})").filter("fingerprint is not null")
    found = found.join(wanted, (F.col("length") == F.col("_length")) & (F.col("fingerprint") == F.col("_fingerprint")), "left_semi")
    # Rows alike are joined with each other's hits once: positions are a set.
    found = stored(found.groupBy(*ROW).agg(F.expr("collect_set(struct(length, pos, fingerprint)) as hits")), "fingerprint-hits")
    full = _with_bit(docs.selectExpr("doc_id as id", "text"), found).selectExpr("id", "xxhash64(text) as text_hash", "text")
    full = full.join(found.hint("merge"), F.col("id").eqNullSafe(found["doc_id"]) & (F.col("text_hash") == found["row_hash"]))
    placed = full.selectExpr(*ROW, f"{WORDS} as words", "hits").selectExpr(*ROW, "words", "inline_outer(hits)").selectExpr("*", *shape)
    hits = placed.selectExpr(*ROW, "length", "fingerprint", "pos", "k", "reach", f"{_context('words')} as doc")
    pairs = hits.join(chosen, ["length", "fingerprint"])
    same = pairs.filter("slice(doc.words, doc.before + 1, k) = slice(item.words, item.before + 1, k)")
    runs = same.selectExpr(*ROW, "item_id", "pos", "k", "length", f"{_run('left')} as l", f"{_run('right')} as r")
    return runs.filter("l + k + r >= length").selectExpr(*ROW, "item_id", "pos - l as first", "pos + k + r as end")


def _with_bit(docs: DataFrame, found: DataFrame, absent: bool = False) -> DataFrame:
    """Rows whose text has a bit in the bitmap of the texts of ``found``; the others if ``absent``."""
    texts = stored(found.select("row_hash").distinct(), "hit-texts")
    bits = bitmap_bits(texts.count())
    test = in_bitmap("_bitmap", "xxhash64(text)", bits)
    marked = docs.withColumn("_bitmap", bitmap_of(texts.withColumnRenamed("row_hash", "hash"), bits).scalar())
    return marked.filter(f"not {test}" if absent else test).drop("_bitmap")


def decontaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """One row per document: words, words hit, items found, whether it is contaminated."""
    found = matches(docs, benchmark, span, k)
    covered = (
        "aggregate(sort_array(collect_set(struct(first, end))), struct(0L as n, 0 as upto), (a, s) ->"
        " struct(a.n + greatest(0, s.end - greatest(s.first, a.upto)) as n, greatest(a.upto, s.end) as upto), a -> a.n)"
    )
    ids = "sort_array(collect_set(cast(item_id as string)))"
    per_doc = found.groupBy(*ROW).agg(F.expr(f"{covered} as n_hit"), F.expr(f"{ids} as ids"))
    counts = docs.selectExpr("doc_id", _ROW_HASH, f"bigint({N_WORDS}) as n_words")
    return counts.join(per_doc.hint("merge"), same_row(counts, per_doc), "left").select(
        counts["doc_id"],
        counts["row_hash"],
        "n_words",
        F.expr("coalesce(n_hit, 0L) as n_hit"),
        F.expr("bigint(coalesce(size(ids), 0)) as n_items"),
        F.expr("sha2(encode(coalesce(array_join(ids, ','), ''), 'UTF-8'), 256) as items_sha256"),
        F.expr("coalesce(n_hit, 0L) > 0 as contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """Documents without a word in common spans; the others go as a whole."""
    bad = stored(matches(docs, benchmark, span, k).select(*ROW).distinct(), "contaminated")
    named = bad.withColumnsRenamed({"doc_id": "_id", "row_hash": "_hash"}).hint("merge")
    doubtful = _with_bit(docs, bad)
    key = doubtful["doc_id"].eqNullSafe(named["_id"]) & (F.xxhash64(doubtful["text"]) == named["_hash"])
    return _with_bit(docs, bad, absent=True).unionByName(doubtful.join(named, key, "left_anti"))
