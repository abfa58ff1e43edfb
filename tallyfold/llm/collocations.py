"""Phrase collocations per language: windows counted once, shorter phrases by marginalisation.

Method. Words stand beside the next words of their piece in lead columns, padded with NULL at the
end of a piece. Only these longest windows are counted; Spark's ROLLUP over them sums the counts of
every shorter prefix, and with them, since each occurrence of a phrase leads exactly one window, the
counts of all phrases of 1 to ``longest`` words and of all words of a language. No n-grams of the
shorter lengths are exploded.

Most windows of a large corpus are single and would only fill the shuffle. So a first pass counts
phrases of 2 words and more by PLACE_BITS bits of a hash and marks the frequent ones in a bitmap. A
window ends, padded, before the first word whose phrase has no bit. Phrases that share a bit by
chance keep windows that could have been cut; nothing frequent is ever cut, so all counts that
the result shows are exact at any size.

A candidate of at least ``least`` occurrences is cut in two at each place; with a, l, r the occurrences
of the whole and its parts, the cut scores floor(10^6 * a^2 / (l * r)), in decimals of 38 digits (exact
up to 10^15 occurrences). The lowest cut counts, ties to the shorter first part. A candidate inside a
longer one with at least ``share`` percent of its occurrences is dropped.

Defined results: A-Z are lower-cased; a piece ends at ``. , ; : ! ?`` and code points 10 to 13, words
at spaces and tabs; a NULL text is empty, a NULL language is ``und``; repeated documents count each
time; ties in score go to the greater a, then to the phrase in byte order. A language without
candidates has no rows; an empty table gives an empty result. Other columns are ignored.

At scale: both counts combine within tasks before their shuffle, so a phrase that fills a third of the
corpus arrives as one row per task. The bitmap is the only thing broadcast: 16 bits per frequent
phrase, 2^MAP_BITS bits (16 MB) at most; with more than 8 million frequent phrases it lets more of the rare
windows through, which costs shuffle, not correctness. The best rows of a language are taken per slice
of its candidates first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import BITS, bitmap_bits, bitmap_of, in_bitmap
from tallyfold.sources.shared import stored

LONGEST = 3
LEAST = 10
SHARE = 50
BEST = 2000
PLACE_BITS = 36
MAP_BITS = BITS
SLICES = 256
SCALE = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII texts take the faster function for the same result.
_LOWERED = f"if(octet_length(t) = length(t), lower(t), translate(t, '{_UPPER}', '{_LOWER}'))"
# A piece ends with a word of its own, a line feed; all words stand between single spaces. Blanks before
# the end of a piece are taken with it from the first one on only, so a long run of them is read once.
_END = r".,;:!?\n\u000b\u000c\r"
_ENDED = f"regexp_replace(t, r'(?<![ \\t])[ \\t]*+[{_END}][{_END} \\t]*+', ' \\n ')"
_SPACED = r"if(contains(t, '  ') or contains(t, '\t'), regexp_replace(t, r'[ \t]++', ' '), t)"


def _columns(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def _leads(docs: DataFrame, n: int) -> DataFrame:
    """One row per word: language and the word with the n - 1 next ones of its piece, NULL beyond its end."""
    texts = docs.selectExpr("coalesce(lang, 'und') as lang", "coalesce(text, '') as t").selectExpr("lang", f"{_LOWERED} as t")
    words = texts.selectExpr("lang", f"{_ENDED} as t").selectExpr("lang", f"split({_SPACED}, ' ') as ws")
    # Outer, since otherwise a filter is inferred that makes the words twice more. Empty words stand at the ends of a text only.
    leads = words.selectExpr("lang", "ws", "posexplode_outer(ws) as (i, w1)").filter("w1 <> '' and w1 <> '\n'")
    for k in range(2, n + 1):
        leads = leads.withColumn("_next", F.expr(f"if(w{k - 1} is null, null, get(ws, i + {k - 1}))"))
        leads = leads.withColumn(f"w{k}", F.expr("if(_next = '\n' or _next = '', null, _next)"))
    return leads.select("lang", *_columns(n))


def _hash(length: int) -> str:
    """SQL text of the hash of the first words of a window, its last bits cut off; NULL if they are fewer."""
    words = ", ".join(_columns(length))
    return f"if(w{length} is null, null, xxhash64(lang, {words}) & {-1 << (64 - PLACE_BITS)}L)"


def _frequent(docs: DataFrame, longest: int, least: int) -> DataFrame:
    """Hashes that phrases of at least ``least`` occurrences in all have."""
    hashes = ", ".join(_hash(length) for length in range(2, longest + 1))
    each = _leads(docs, longest).selectExpr(f"explode_outer(array({hashes})) as hash").filter("hash is not null")
    frequent = each.groupBy("hash").agg(F.expr("count(*) as n")).filter(f"n >= {least}").select("hash")
    return stored(frequent, "frequent-phrases")


def _padded(windows: DataFrame, bitmap: DataFrame, bits: int, n: int) -> DataFrame:
    """Windows that end before their first word whose phrase has no bit."""
    marked = windows.withColumn("_bitmap", bitmap.scalar())
    kept = "true"
    for i in range(2, n + 1):
        marked = marked.withColumn(f"_hash{i}", F.expr(_hash(i)))
        marked = marked.withColumn(f"_kept{i}", F.expr(f"{kept} and w{i} is not null and {in_bitmap('_bitmap', f'_hash{i}', bits)}"))
        kept = f"_kept{i}"
    cut = [f"if(_kept{i}, w{i}, null) as w{i}" for i in range(2, n + 1)]
    return marked.selectExpr("lang", "w1", *cut)


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Occurrences ``n`` per language of every phrase (``w1`` ...) that may have ``least`` of them.

    ``words`` is the number of words of the phrase; rows with 0 words count all words of a language.
    """
    words = _columns(longest)
    frequent = _frequent(docs, longest, least)
    bits = bitmap_bits(frequent.count(), MAP_BITS)
    windows = _padded(_leads(docs, longest), bitmap_of(frequent, bits), bits, longest)
    counted = windows.groupBy("lang", *words).agg(F.expr("count(*) as n"))
    summed = counted.rollup("lang", *words).agg(F.expr("sum(n) as n"), F.expr("grouping_id() as gid"))
    # A prefix is all columns of a grouping; one that holds padding repeats a shorter one.
    lengths = [f"when gid = {(1 << (longest - k)) - 1} then {k}" for k in range(longest + 1)]
    rows = summed.selectExpr("*", f"case {' '.join(lengths)} end as words").filter("words is not null")
    full = " and ".join(f"(words < {i} or w{i} is not null)" for i in range(1, longest + 1))
    return rows.filter(f"({full}) and (words = 0 or n >= {least})").select("lang", *words, "words", "n")


def _phrase(first: int, last: int) -> str:
    return f"concat_ws(' ', {', '.join(f'w{i}' for i in range(first, last + 1))})"


def _scored(phrases: DataFrame, lengths: range, k: int) -> DataFrame:
    """Candidates of all lengths that can be cut after k words, with the occurrences of both parts."""
    parts = phrases.filter(f"words < {lengths[-1]}").selectExpr("lang as _lang", "phrase as part", "n as part_n")
    rows = reduce(
        DataFrame.unionByName,
        [
            phrases.filter(f"words = {m}").selectExpr("lang", "phrase", "n", f"{_phrase(1, k)} as left_part", f"{_phrase(k + 1, m)} as right_part")
            for m in lengths
            if k < m
        ],
    )
    for side in ("left", "right"):
        named = parts.withColumnsRenamed({"part": f"_{side}", "part_n": side[0]})
        rows = rows.join(named, (F.col("lang") == named["_lang"]) & (F.col(f"{side}_part") == named[f"_{side}"])).drop("_lang", f"_{side}")
    number = "cast({} as decimal(15, 0))".format
    score = f"({number('n')} * {number('n')} * {SCALE}BD) div ({number('l')} * {number('r')})"
    return rows.selectExpr("lang", "phrase", "n as a", "l", "r", f"{k} as k", f"{score} as score")


def _held(phrases: DataFrame, lengths: range, share: int) -> DataFrame:
    """Candidates inside a longer one that has ``share`` percent of their occurrences."""
    inside = reduce(
        DataFrame.unionByName,
        [
            phrases.filter(f"words = {m}").selectExpr("lang", "n", f"{_phrase(s, s + short - 1)} as phrase")
            for m in lengths
            for short in lengths
            if short < m
            for s in range(1, m - short + 2)
        ],
    )
    most = inside.groupBy("lang", "phrase").agg(F.expr("max(n) as most"))
    own = phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias("own"))
    pairs = most.join(own, (most["lang"] == own["_lang"]) & (most["phrase"] == own["_phrase"]))
    return pairs.filter(f"100 * most >= {share} * own").select("_lang", "_phrase")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, best: int = BEST
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = stored(phrase_counts(docs, longest, least), "phrase-counts")
    lengths = range(2, longest + 1)
    text = f"concat_ws(' ', {', '.join(_columns(longest))}) as phrase"
    phrases = counts.filter("words > 0").selectExpr("*", text)
    cuts = reduce(DataFrame.unionByName, [_scored(phrases, lengths, k) for k in range(1, longest)])
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.expr("min(struct(score, k, l, r)) as cut"))
    scored = lowest.selectExpr("lang", "phrase", "a", "cut.l as l", "cut.r as r", "cut.score as score")
    if longest > 2:
        held = _held(phrases, lengths, share)
        scored = scored.join(held, (scored["lang"] == held["_lang"]) & (scored["phrase"] == held["_phrase"]), "left_anti")
    order = "order by score desc, a desc, phrase"
    sliced = scored.selectExpr("*", f"row_number() over (partition by lang, pmod(xxhash64(phrase), {SLICES}) {order}) as _place")
    ranked = sliced.filter(f"_place <= {best}").selectExpr("*", f"row_number() over (partition by lang {order}) as rank").filter(f"rank <= {best}")
    totals = counts.filter("words = 0").selectExpr("lang as _lang", "n")
    joined = ranked.join(totals, ranked["lang"] == totals["_lang"])
    return joined.selectExpr("lang", "bigint(rank) as rank", "phrase", "a", "l", "r", "n", "score")
