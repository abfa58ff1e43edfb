"""Mixing sources to target weights.

Method: Pareto order sampling. A source whose target is ``f`` times its size gives every document
``floor(f)`` certain copies. What is left of the target is met by a sample without repeats: each
document has an inclusion probability, and documents are ranked by their random odds divided by
their inclusion odds. The sample is of fixed size in words: the shortest or longest run of ranks,
whichever sum is nearer to what is left. Inclusion probabilities grow with the length of a document
(``length_tilt``; 0 makes them equal) and add up to what is left, in words.

Targets: sources in code point order, NULL last, weigh ``weights`` in turn, and share ``share`` times
all sizes; none is above ``max_copies`` times its size, the excess goes to the others by weight. That
is the level L with sum(min(cap, weight * L)) = total, the largest of the levels that result when the
first k sources by cap / weight are taken as capped.

Defined results: a NULL text has size 0; documents of size 0 get the certain copies only; a source of
size 0 has target 0. Random numbers come from the seed and ``doc_id``, so reruns agree; repeated or
missing ids share one number, ties are broken by size and text, and rows alike in all three are taken together. Other columns are ignored.

At scale: sizes are counted in one pass and written as narrow rows to the shared folder. The cut in
the order of ranks is found from sums per source and per one of ``2^16`` ranges of ranks; only the
documents of one range per source are numbered, so a source with a third of all rows puts no more
than that range's share of them into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import ROW_HASH, words_of
from tallyfold.sources.shared import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
LENGTH_TILT = 0.5
SEED = 7
RANGES = 1 << 16
_MIDDLE = 512  # words at which a document is half way to the highest inclusion probability


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: size, documents, target. ``sizes`` has source and size; sources are few against documents.

    ``tilted`` is a sum in millionths of words, beyond 64 bits for a corpus of some terabytes.
    """
    listed = ", ".join(str(weight) for weight in weights)
    tilt = f"size div 1 * 1000000L div (size + {_MIDDLE})"
    sources = sizes.groupBy("source").agg(
        F.expr("sum(size) as source_size"), F.expr("count(*) as n_docs"), F.expr(f"sum(cast(({tilt}) * size as decimal(20, 0))) as tilted")
    )
    order = "row_number() over (order by source asc nulls last)"
    weighed = sources.selectExpr("*", f"array({listed})[({order} - 1) % {len(weights)}] as weight")
    caps = weighed.selectExpr("*", f"source_size * {max_copies}L as cap")
    before = "over (order by cap / weight, source asc nulls first rows between unbounded preceding and 1 preceding)"
    level = (
        f"try_divide({share}D * sum(source_size) over () - coalesce(sum(cap) {before}, 0L),"
        f" double(sum(weight) over () - coalesce(sum(weight) {before}, 0L)))"
    )
    levels = caps.selectExpr("*", f"{level} as level")
    return levels.selectExpr(
        "source", "source_size", "n_docs", "tilted",
        "least(double(cap), weight * coalesce(max(level) over (), 0D)) as target",
    )


def _uniform(seed: int) -> str:
    """SQL text of a number between 0 and 1 from the seed and the id; 52 bits of an MD5 sum."""
    key = f"md5(encode(concat('{seed}:', coalesce(cast(doc_id as string), '')), 'UTF-8'))"
    return f"(cast(conv(substr({key}, 1, 13), 16, 10) as bigint) + 0.5D) / 4503599627370496D"


def _inclusion(length_tilt: float) -> str:
    """SQL text of the inclusion probability; weighted by sizes the probabilities average to ``part``."""
    mine = f"(size * 1000000L div (size + {_MIDDLE})) / 1000000D"
    mean = "coalesce(try_divide(double(tilted), double(source_size)), 0D) / 1000000D"
    return f"part + {length_tilt}D * least(part, 1D - part) * ({mine} - {mean})"


def mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    length_tilt: float = LENGTH_TILT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: size, its source's size and target, copies the mix takes and their words."""
    sized = docs.selectExpr("doc_id", ROW_HASH, "source", f"bigint(size({words_of('text')})) as size", f"{_uniform(seed)} as u")
    sizes = stored(sized, "mixing-sizes")
    targets = stored(source_targets(sizes, weights, share, max_copies), "mixing-targets")
    targets = targets.selectExpr("source as of", "source_size", "tilted", "target", "try_divide(target, double(source_size)) as f")
    targets = targets.selectExpr("*", "coalesce(int(floor(f)), 0) as whole", "coalesce(f - floor(f), 0D) as part")
    docs_of = sizes.join(targets, sizes["source"].eqNullSafe(targets["of"])).drop("of")
    ranked = docs_of.selectExpr("*", f"{_inclusion(length_tilt)} as p").selectExpr(
        "*", "if(part > 0, (u / (1D - u)) / (p / (1D - p)), cast(null as double)) as q", "target - whole * double(source_size) as rest"
    )
    ranked = ranked.selectExpr("*", f"int(floor(q / (1D + q) * {RANGES})) as q_range")
    # The range in which the running sum of sizes passes what is left.
    sums = ranked.filter("q is not null").groupBy("source", "q_range").agg(
        F.expr("sum(size) as words"), F.expr("max(rest) as left_over")
    )
    before = "sum(words) over (partition by source order by q_range rows between unbounded preceding and 1 preceding)"
    sums = sums.selectExpr("*", f"coalesce({before}, 0L) as words_before")
    cuts = sums.filter("words_before <= left_over").groupBy("source").agg(
        F.expr("max_by(q_range, q_range) as cut"), F.expr("max_by(words_before, q_range) as words_before")
    )
    cuts = stored(cuts, "mixing-cuts").withColumnRenamed("source", "of")
    placed = ranked.join(cuts, ranked["source"].eqNullSafe(cuts["of"]), "left").drop("of")
    # Inside that range: the last document taken brings the sum nearest to what is left. Rows alike
    # share a rank and are taken or left together.
    inside = placed.filter("q_range = cut")
    upto = "sum(size) over (partition by source order by q, doc_id, size, row_hash range between unbounded preceding and current row)"
    alike = "sum(size) over (partition by source, q, doc_id, size, row_hash)"
    inside = inside.selectExpr("*", f"words_before + {upto} as total", f"{alike} as mine")
    inside = inside.withColumn("taken_once", F.expr("total <= rest or total - rest < rest - (total - mine)"))
    outside = placed.filter("q_range is null or cut is null or q_range <> cut")
    outside = outside.withColumn("taken_once", F.expr("coalesce(q_range < cut, false)"))
    both = inside.drop("total", "mine").unionByName(outside)
    both = both.selectExpr("*", "whole + int(taken_once) as copies")
    return both.selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken", "copies", "row_hash")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix: each document as often as it is taken."""
    taken = mixed(docs, **options).groupBy("doc_id", "row_hash").agg(F.expr("max(copies) as copies"))
    taken = taken.withColumnsRenamed({"doc_id": "_id", "row_hash": "_hash", "copies": "_copies"}).filter("_copies > 0")
    key = docs["doc_id"].eqNullSafe(taken["_id"]) & (F.xxhash64(docs["text"], docs["source"]) == taken["_hash"])
    repeated = docs.join(taken, key).withColumn("_copy", F.expr("explode(sequence(1, _copies))"))
    return repeated.drop("_id", "_hash", "_copies", "_copy")
