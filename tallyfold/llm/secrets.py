"""Secrets in texts: known shapes, and strings that pass a battery of randomness tests.

Method. Known shapes are assignments to a secret's name, access keys and long hexadecimal strings.
Further candidates are long strings of letters and digits (with ``+ / _ -``) that hold a letter, and
the long parts of these between ``/ - _``; a part is not reported beside the whole that holds it. The
encoding of a candidate is the smallest alphabet it fits (hexadecimal in either case, also with
hyphens; letters of one case; base 32; base 36 of one case; letters; base 64), and three tests look at
its characters as numbers of that alphabet:

* chi-squared: are all characters of the alphabet equally frequent;
* runs: do values above and below the middle follow each other as often as chance has it;
* serial correlation: does a value depend on the one before it.

A candidate is not reported if the runs or the serial test rejects randomness (``alpha``, after
Bonferroni). For the others the chi-squared sum is held against text: letters of text agree with
probability ``text_repeat`` (those that can stand in hexadecimal strings: ``HEX_REPEAT``), so the sum is about df + n * (k * text_repeat - 1) for n characters of
an alphabet of k, and a random string falls far below that, the farther the longer it is. That gives
a p-value under "this is text". The false discovery rate ``rate`` is controlled per length class
(Benjamini and Hochberg), so the many short strings of a corpus do not loosen what long ones need.
Tables of p-values hold fixed steps, rounded up.

Defined results: positions count code points, ends are exclusive; a NULL text is empty; repeated
rows each get a row and each add to the false discovery tables; an empty table gives an empty
result. Spans of the method have the kind ``random`` and may lie on known ones, which all stay.

At scale: time grows with the length of a text, however many matches it has. One pass over the texts writes spans and candidates (narrow) to the shared folder. The
only other exchange is the count of p-values, 3 classes of 401 steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import let
from tallyfold.sources.shared import stored

ALPHA = 0.001
RATE = 0.01
# How often two letters of English agree, and two of its letters a to f; rounded down.
TEXT_REPEAT, HEX_REPEAT = 0.065, 0.25
MIN_LENGTH = 20
STEPS, STEP = 400, 4.0

# The shapes of known secrets. Hexadecimal and access strings are whole runs, so their
# least length can stand in the pattern; an assignment's must be tested after the match.
_ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
_ACCESS = r"AKIA[A-Z0-9]{16,}"
_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
_CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
_PART = r"(?<![A-Za-z0-9+])[A-Za-z0-9+]{20,}"
KINDS = ("assign", "access", "hex", "random")

_HEXADECIMAL = "0123456789abcdef"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


_BLOCK = 128


def _starts(lengths: str) -> str:
    """SQL text of the running sums before each element of a non-empty array, appended per block so that no long array is copied per element."""
    blocks = f"transform(sequence(0, (size(ls) - 1) div {_BLOCK}), b -> slice(ls, b * {_BLOCK} + 1, {_BLOCK}))"
    running = "aggregate({0}, array(0), (a, n) -> array_append(a, element_at(a, -1) + n))"
    inner = f"transform({blocks}, block -> {running.format('block')})"
    bases = running.format("transform(sums, a -> element_at(a, -1))")
    moved = "flatten(transform(sums, (a, b) -> transform(slice(a, 1, size(a) - 1), n -> n + bases[b])))"
    return let("ls", lengths, let("sums", inner, let("bases", bases, moved)))


def _spans(pattern: str, keep: str = "true", text: str = "t", extra: str = "") -> str:
    """SQL text of the spans (start, end) of a pattern, leftmost and not overlapping.

    Splitting on the pattern gives the texts between the matches; sums of lengths give positions.
    ``keep`` is a test of ``m`` (number of the match from 0), ``extra`` a further field of the span.
    """
    ends = "transform(ms, (x, m) -> length(gaps[m]) + length(x))"
    span = f"struct(at[m] + length(gaps[m]) as s, at[m] + length(gaps[m]) + length(ms[m]) as e{extra})"
    places = let("at", _starts(ends), f"transform(filter(sequence(0, size(ms) - 1), m -> {keep}), m -> {span})")
    matched = let("ms", f"regexp_extract_all({text}, r'{pattern}', 0)", let("gaps", f"split({text}, r'{pattern}')", places))
    kind = "struct<s: int, e: int, x: string>" if extra else "struct<s: int, e: int>"
    return f"if({text} rlike r'{pattern}', {matched}, cast(array() as array<{kind}>))"


def _tail(z: str) -> str:
    """SQL text of the upper tail of the normal distribution, good to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    body = let(
        "k",
        "1 / (1 + 0.2316419D * abs(z))",
        "exp(-z * z / 2) * 0.3989422804D * k * (0.319381530D + k * (-0.356563782D + k * (1.781477937D + k * (-1.821255978D + k * 1.330274429D))))",
    )
    return let("z", z, let("q", body, "if(z >= 0, q, 1 - q)"))


def _battery(text: str, alpha: float, text_repeat: float) -> str:
    """SQL text of the p-value of a candidate under "this is text"; 1 where a test speaks against chance."""
    known = [
        ("^([0-9a-f-]+|[0-9A-F-]+)$", _HEXADECIMAL, f"lower(replace({text}, '-', ''))"),
        ("^([a-z]+|[A-Z]+)$", _LETTERS[:26], f"lower({text})"),
        ("^[A-Z2-7]+$", _BASE32, text),
        ("^([a-z0-9]+|[A-Z0-9]+)$", _BASE36, f"lower({text})"),
        ("^[A-Za-z]+$", _LETTERS, text),
        ("", _BASE64, f"translate({text}, '-_', '+/')"),
    ]
    repeat = {_HEXADECIMAL: HEX_REPEAT}
    cases = [f"when {text} rlike '{shape}' then struct('{a}' as a, {len(a)} as k, {repeat.get(a, text_repeat)}D as r, {v} as v)" for shape, a, v in known]
    alphabet = f"case {' '.join(cases)} end"
    values = "transform(split(enc.v, ''), c -> instr(enc.a, c) - 1)"
    # Number of equal pairs, from the lengths of runs in sorted order.
    squares = (
        "aggregate(sort_array(xs), struct(-1 as last, 0L as run, 0L as total), (a, x) -> if(x = a.last,"
        " struct(x as last, a.run + 1 as run, a.total + 2 * a.run + 1 as total), struct(x as last, 1L as run, a.total + 1 as total)), a -> a.total)"
    )
    moments = (
        "aggregate(xs, struct(-1 as last, 0L as runs, 0L as high, 0L as s, 0L as ss, 0L as cross), (a, x) -> struct(x as last,"
        " a.runs + int(a.last < 0 or (a.last >= enc.k div 2) != (x >= enc.k div 2)) as runs, a.high + int(x >= enc.k div 2) as high,"
        " a.s + x as s, a.ss + x * x as ss, if(a.last < 0, 0L, a.cross + a.last * x) as cross))"
    )
    runs = let(
        "m",
        "struct(double(mo.high) as n1, double(n - mo.high) as n2)",
        "try_divide(mo.runs - (2 * m.n1 * m.n2 / n + 1), sqrt(2 * m.n1 * m.n2 * (2 * m.n1 * m.n2 - n) / (double(n) * n * (n - 1))))",
    )
    mean = "(double(mo.s) / n)"
    serial = (
        f"try_divide(mo.cross - {mean} * (2 * mo.s - xs[0] - xs[n - 1]) + (n - 1) * {mean} * {mean}, mo.ss - n * {mean} * {mean}) * sqrt(n)"
    )
    chi = "double(enc.k) * sq / n - n"
    shift = "(n * greatest(0D, enc.k * enc.r - 1))"
    against_text = f"(({chi}) - (enc.k - 1) - {shift}) / sqrt(2 * (enc.k - 1 + 2 * {shift}))"
    odd = f"least(2 * {_tail('abs(z2)')}, 2 * {_tail('abs(z3)')}) < {alpha / 2}D"
    verdict = let("z2", f"coalesce({runs}, 99D)", let("z3", f"coalesce({serial}, 99D)", f"if({odd}, 1D, {_tail(f'-({against_text})')})"))
    inner = let("n", "size(xs)", let("sq", squares, let("mo", moments, verdict)))
    return let("enc", alphabet, let("xs", f"filter({values}, x -> x >= 0)", f"if(size(xs) < {MIN_LENGTH}, 1D, {inner})"))


def _found(docs: DataFrame, alpha: float, text_repeat: float) -> DataFrame:
    """One row per document: spans of known shapes, candidates (each with its parts) with class and step of their p-value."""
    texts = docs.selectExpr("doc_id", "coalesce(text, '') as t")
    assign = let("gs", f"regexp_extract_all(t, r'{_ASSIGN}', 2)", _spans(_ASSIGN, "length(gs[m]) >= 6"))
    step = f"int(least({STEPS}, floor(-ln(greatest(p, 1e-300D)) * {STEP}D)))"

    def tested(span: str, offset: str) -> str:
        """A candidate with class and step; NULL without a letter."""
        size = f"({span}.e - {span}.s)"
        place = f"{offset} + {span}.s as s, {offset} + {span}.e as e, int({size} >= 32) + int({size} >= 64) as class"
        body = let("p", _battery(f"{span}.x", alpha, text_repeat), f"struct({place}, {step} as step)")
        return f"if({span}.x rlike '[A-Za-z]', {body}, null)"

    # A part lies in exactly one whole, and is looked for there.
    parts = f"transform(filter({_spans(_PART, text='w.x', extra=', ms[m] as x')}, c -> c.e - c.s < w.e - w.s), c -> {tested('c', 'w.s')})"
    group = f"struct({tested('w', '0')} as whole, filter({parts}, c -> c is not null) as parts)"
    groups = f"transform({_spans(_CANDIDATE, extra=', ms[m] as x')}, w -> {group})"
    return texts.selectExpr(
        "doc_id",
        f"{assign} as assign",
        f"{_spans(_ACCESS)} as access",
        f"{_spans(_HEX)} as hex",
        f"filter({groups}, g -> g.whole is not null) as candidates",
    )


def _cuts(found: DataFrame, rate: float) -> DataFrame:
    """Per length class the largest p-value step that Benjamini and Hochberg's rule accepts."""
    listed = found.selectExpr("inline(flatten(transform(candidates, g -> concat(array(g.whole), g.parts))))")
    each = listed.groupBy("class", "step").agg(F.expr("count(*) as n"))
    total = "sum(n) over (partition by class)"
    upto = "sum(n) over (partition by class order by step desc)"
    accepted = each.selectExpr("class", "step", f"{upto} as rank", f"{total} as total").filter(f"exp(-step / {STEP}D) <= {rate}D * rank / total")
    return accepted.groupBy("class").agg(F.expr("min(step) as cut"))


def secrets(
    docs: DataFrame, alpha: float = ALPHA, rate: float = RATE, text_repeat: float = TEXT_REPEAT
) -> DataFrame:
    """One row per document: the spans of each kind, as arrays of (start, end)."""
    found = stored(_found(docs, alpha, text_repeat), "secret-spans")
    cuts = {row["class"]: row["cut"] for row in _cuts(found, rate).collect()}  # three rows at most
    tests = " or ".join(f"(c.class = {size} and c.step >= {cut})" for size, cut in sorted(cuts.items())) or "false"
    # Wholes are in order and apart, and so are the parts of each.
    passed = f"transform(candidates, g -> concat(filter(array(g.whole), c -> {tests}), filter(g.parts, c -> {tests})))"
    alone = f"transform({passed}, (cs, i) -> if(size(cs) > 1 and cs[0].e = candidates[i].whole.e and cs[0].s = candidates[i].whole.s, slice(cs, 1, 1), cs))"
    reported = f"transform(flatten({alone}), c -> struct(c.s, c.e))"
    return found.selectExpr("doc_id", "assign", "access", "hex", f"{reported} as random")


def _joined(kinds: tuple[str, ...]) -> str:
    """SQL text of all spans as kind:start:end, by start, then kind as listed."""
    listed = [f"transform({kind}, c -> struct(c.s as s, {place} as o, concat('{kind}:', c.s, ':', c.e) as text))" for place, kind in enumerate(kinds)]
    return f"array_join(sort_array(concat({', '.join(listed)})).text, ',')"


def digest(found: DataFrame) -> DataFrame:
    """Counts and texts of the spans, one row per document."""
    return found.selectExpr(
        "doc_id",
        *[f"bigint(size({kind})) as n_{kind}" for kind in KINDS],
        f"sha2(encode({_joined(KINDS[:3])}, 'UTF-8'), 256) as base_sha256",
        f"{_joined(KINDS)} as spans",
    )
