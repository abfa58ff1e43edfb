"""Quality rules: counts within a text, and lines that too many documents of a host share.

Method: cross-document line frequency. Lines are normalised (white space collapsed, lower case) and
hashed; per host (``source``) and line the documents that have it are counted. The limit is a share of the
documents of the host, so that it is alike at every size: ``LONG`` for lines of ``LONG_LINE`` words and
more, which documents hardly share by chance, ``SHORT`` for others, both beside a number of documents that
small hosts need. A line above its limit is removed from all its documents but the first, and a document that loses most of its words
is rejected. The first document (smallest ``doc_id``) keeps the line, so that of a group of copies
one is left whole.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL source is a host
of its own; every row counts as one document, also a repeated one, while a line that stands twice in
one document counts once; documents without an id never keep a line that is above the limit unless
no document of the host with that line has an id. Other columns are ignored.

At scale: counts per line are partial sums before the shuffle, so the commonest line costs one row
per task. Only lines above the limit meet the lines of the documents, in a join on (host, line) that
Spark broadcasts when it measures the side as small and otherwise splits where a line is hot. The
texts are read once: counts and line hashes go to the shared folder, the rest works on those.
``line_quality`` never shuffles a text; ``clean_documents`` moves them once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import BLANK, BLANKS, ROW, ROW_HASH, let, same_row, words_of
from tallyfold.sources.shared import stored

# (documents, thousandths of the documents of the host): a line in more than both is too frequent.
LONG, SHORT = (4, 2), (20, 50)
LONG_LINE = 20
MIN_LEFT = 0.3
MIN_WORDS = 50

_NORMAL = f"lower(regexp_replace(trim(BOTH {BLANKS} FROM l), r'{BLANK}+', ' '))"
_LINES = "split(coalesce(text, ''), '\\n')"


def _repeated_words() -> str:
    """SQL text: words of ``ws`` inside windows of three words that occur more than once.

    Windows are compared by 64-bit hashes. If some are equal, hashes are sorted with their
    positions: equal windows become neighbours.
    """
    windows = "transform(sequence(0, size(ws) - 3), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2]))"
    placed = "sort_array(transform(hs, (h, i) -> struct(h, i)))"
    found = "transform(ps, (x, k) -> if((k > 0 and x.h = ps[k - 1].h) or (k < size(ps) - 1 and x.h = ps[k + 1].h), x.i, null))"
    starts = f"sort_array(filter({found}, x -> x is not null))"
    covered = "aggregate(at, struct(0 as n, -3 as last), (a, x) -> struct(a.n + least(3, x - a.last) as n, x as last), a -> a.n)"
    some = let("ps", placed, let("at", starts, covered))
    return f"if(size(ws) < 3, 0, {let('hs', windows, f'if(size(array_distinct(hs)) = size(hs), 0, {some})')})"


def _counts() -> str:
    """SQL text of a struct with the counts within one text."""
    lines = f"filter({_LINES}, l -> trim(BOTH {BLANKS} FROM l) != '')"
    duplicates = let("ls", lines, "size(ls) - size(array_distinct(ls))")
    return let(
        "ws",
        words_of("text"),
        "struct(bigint(size(ws)) as n_words, bigint(length(array_join(ws, ''))) as word_chars,"
        " bigint(size(split(coalesce(text, ''), '[#*$%&|<>]')) - 1) as n_symbols,"
        f" bigint({duplicates}) as n_dup_lines, bigint({_repeated_words()}) as n_repeat_words)",
    )


# The lowest bit of a line's hash tells long lines.
_HASH = f"(xxhash64(n) & -2L) | bigint(size(split(n, ' ')) >= {LONG_LINE})"
_USED = f"filter({_LINES}, l -> trim(BOTH {BLANKS} FROM l) != '')"


def _facts(docs: DataFrame) -> DataFrame:
    """Counts and line hashes per document, in one pass over the texts; written to the shared folder."""
    hashed = let("n", _NORMAL, f"struct({_HASH} as line, size(split(n, ' ')) as words)")
    lines = f"transform({_USED}, l -> {hashed}) as lines"
    return stored(docs.selectExpr("doc_id", ROW_HASH, "source", lines, f"inline(array({_counts()}))"), "line-quality")


Limit = tuple[int, int]


def frequent_lines(facts: DataFrame, long: Limit = LONG, short: Limit = SHORT) -> DataFrame:
    """Lines in too many documents of a host, with the document that keeps each."""
    once = facts.selectExpr("doc_id", "source", "explode(array_distinct(lines.line)) as line")
    counted = once.groupBy("source", "line").agg(F.expr("count(*) as documents"), F.expr("min(doc_id) as first_doc"))
    # Few lines pass the first test; only those meet the sizes of the hosts.
    some = counted.filter(f"documents > if(line & 1 = 1, {long[0]}, {short[0]})")
    hosts = facts.groupBy("source").agg(F.expr("count(*) as host_documents")).withColumnRenamed("source", "host")
    joined = some.join(hosts, some["source"].eqNullSafe(hosts["host"]))
    return joined.filter(f"1000 * documents > if(line & 1 = 1, {long[1]}, {short[1]}) * host_documents").drop("host", "host_documents")


def _removed(facts: DataFrame, long: Limit, short: Limit) -> DataFrame:
    """Per document that loses lines: their words and hashes."""
    frequent = frequent_lines(facts, long, short).selectExpr("source as host", "line as gone", "first_doc")
    lines = facts.selectExpr(*ROW, "source", "posexplode(lines) as (pos, l)")
    lines = lines.selectExpr(*ROW, "source", "pos", "l.line", "l.words")
    condition = (
        (lines["line"] == frequent["gone"])
        & lines["source"].eqNullSafe(frequent["host"])
        & ~lines["doc_id"].eqNullSafe(frequent["first_doc"])
    )
    # By position first: a repeated row brings each of its lines once more.
    once = lines.join(frequent, condition).groupBy(*ROW, "pos").agg(F.expr("max(struct(line, words)) as l"))
    return once.groupBy(*ROW).agg(F.expr("sum(l.words) as removed"), F.expr("collect_set(l.line) as gone"))


def _verdicts(docs: DataFrame, long: Limit, short: Limit, min_left: float, min_words: int) -> DataFrame:
    facts = _facts(docs)
    counts, removed = facts.drop("lines", "source"), _removed(facts, long, short)
    joined = counts.join(removed, same_row(counts, removed), "left").select(
        *[counts[name] for name in counts.columns],
        F.expr(f"n_words < {min_words} or 100 * n_repeat_words > 50 * n_words as base_failed"),
        F.expr("n_words - coalesce(removed, 0L) as n_left"),
        "gone",
    )
    return joined.withColumn("kept", F.expr(f"not base_failed and n_left >= {min_left}D * n_words"))


def line_quality(
    docs: DataFrame,
    long: Limit = LONG,
    short: Limit = SHORT,
    min_left: float = MIN_LEFT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document: counts, verdict of the base rules, words left, and whether it is kept."""
    return _verdicts(docs, long, short, min_left, min_words).drop("gone")


def clean_documents(
    docs: DataFrame,
    long: Limit = LONG,
    short: Limit = SHORT,
    min_left: float = MIN_LEFT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Documents that are kept, without their frequent lines; ``n_chars`` follows the text."""
    kept = _verdicts(docs, long, short, min_left, min_words).filter("kept")
    edits = kept.groupBy(*ROW).agg(F.expr("first(gone) as gone")).withColumnsRenamed({"doc_id": "_id", "row_hash": "_hash", "gone": "_gone"})
    key = docs["doc_id"].eqNullSafe(edits["_id"]) & (F.xxhash64(docs["text"], docs["source"]) == edits["_hash"])
    left = f"array_join(filter({_LINES}, l -> not array_contains(_gone, {let('n', _NORMAL, _HASH)})), '\\n')"
    changed = {"text": F.expr(f"if(_gone is null, text, {left})")}
    if "n_chars" in docs.columns:
        number = f"if(_gone is null, n_chars, length({left}))"
        changed["n_chars"] = F.expr(number).cast(docs.schema["n_chars"].dataType)
    return docs.join(edits, key).withColumns(changed).drop("_id", "_hash", "_gone")
