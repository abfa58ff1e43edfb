"""Periodic runs of words in documents, found by seeds on diagonals and their extension.

A run of period q is a stretch of words in which words q apart are identical, that no neighbouring
word extends, of ``max(24, 3 * q)`` words or more, q being its smallest period.

Method. A run of period q repeats itself q words on, over ``max(24 - q, 2 * q)`` words or more. So for
periods up to 16 any run holds a pair of equal 16-grams q apart, and for periods above k / 2 up to k
(k = 32, 64, ...) a pair of equal k-grams. The grams of each such k are indexed under exact
names, built by doubling (the name of 2k words is the pair of two names of k), and a place whose gram
is single in its document is left out of all longer ones. Pairs of one gram are listed for
neighbouring places only: a gram of q words or more recurs inside a run first after exactly q words,
or else q would not be the smallest period. Each seed is extended to both sides along its
diagonal (words at a fixed lag); a table of how far each lag is covered suppresses the seeds that an
earlier extension has passed. The work of a document of n words is n log(n) sorted places, also if one
word fills it.

Some documents are made periodic first, as a fixed test pattern: with h = crc32 of the decimal
``doc_id`` and g = h // 10, if h % 10 = 0 each word from a = g % n on becomes the original word
a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).

Defined results: words are runs of characters other than code points 32 and 9 to 13; NULL and empty
texts have none, no runs, and hashes of the empty text. A document without an id is not made
periodic. Repeated documents each get a row; ties for the greatest exponent go to the smallest
start, then period. Other columns are ignored; an empty table gives an empty result.

At scale: one pass, no shuffle; a task holds the words of one document, or of ``WORDS_AT_ONCE`` if
documents are short.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
SEED = 16
WORDS_AT_ONCE = 200_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Run = tuple[int, int, int]  # start, length, period

_COLUMNS = {
    "doc_id": "bigint",
    "n_runs": "bigint",
    "start": "bigint",
    "length": "bigint",
    "period": "bigint",
    "exponent_milli": "bigint",
    "runs_sha256": "string",
    "collapsed_sha256": "string",
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


def made_periodic(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document, periodic from some word on in one of ten documents."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def _numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, different for each document, with a single number after each; first places."""
    numbers: list[int] = []
    starts, base = [], 0
    for words in texts:
        known: dict[str, int] = {}
        starts.append(len(numbers))
        numbers += [known.setdefault(word, base + len(known)) for word in words]
        base += len(known) + 1
        numbers.append(base - 1)
    return np.array(numbers, np.int64), np.array(starts, np.int64)


def _seeds(numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lag, place) of neighbouring equal grams whose length fits the lag, sorted; one of places in a row."""
    names = np.full(len(numbers), -1, np.int64)
    places, keys, k = np.arange(len(numbers)), numbers, 1
    while len(places):
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        as_before = np.append(False, keys[1:] == keys[:-1])
        as_next = np.append(as_before[1:], False)
        if k >= SEED:
            second = np.flatnonzero(as_before)
            lags = places[second] - places[second - 1]
            fit = (lags <= k) & ((lags > k // 2) | (k == SEED))
            lags, first = lags[fit], places[second - 1][fit]
            order = np.lexsort((first, lags))
            lags, first = lags[order], first[order]
            fresh = np.append(True, (lags[1:] != lags[:-1]) | (first[1:] != first[:-1] + 1))[: len(lags)]
            yield lags[fresh], first[fresh]
        again = as_before | as_next
        names[:] = -1
        names[places[again]] = np.cumsum(~as_before)[again]
        places = np.flatnonzero(names >= 0)
        places = places[places + k < len(names)]
        places = places[names[places + k] >= 0]
        keys = names[places] * (len(names) + 1) + names[places + k]
        k *= 2


def _first_change(numbers: np.ndarray, place: int, lag: int) -> int:
    """First place from ``place`` on whose word differs from the one ``lag`` words on."""
    end, size = len(numbers) - lag, 64
    while place < end:
        upto = min(place + size, end)
        differs = np.flatnonzero(numbers[place:upto] != numbers[place + lag : upto + lag])
        if len(differs):
            return place + int(differs[0])
        place, size = upto, 2 * size
    return end


def _last_change(numbers: np.ndarray, place: int, lag: int) -> int:
    """Place after the last one before ``place`` whose word differs from the one ``lag`` words on."""
    size = 64
    while place > 0:
        start = max(0, place - size)
        differs = np.flatnonzero(numbers[start:place] != numbers[start + lag : place + lag])
        if len(differs):
            return start + int(differs[-1]) + 1
        place, size = start, 2 * size
    return 0


def runs_of(texts: list[list[str]]) -> list[list[Run]]:
    """Runs of each list of words, by start, then period."""
    numbers, starts = _numbered(texts)
    found: list[list[Run]] = [[] for _ in texts]
    covered: dict[int, int] = {}
    for lags, places in _seeds(numbers):
        for lag, place in zip(lags.tolist(), places.tolist(), strict=True):
            if place < covered.get(lag, 0):
                continue
            first, end = _last_change(numbers, place, lag), _first_change(numbers, place, lag)
            covered[lag] = end
            length = end - first + lag
            if length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag):
                text = int(np.searchsorted(starts, first, "right")) - 1
                found[text].append((first - int(starts[text]), length, lag))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def _strongest(runs: list[Run]) -> Run:
    best = runs[0]
    for run in runs[1:]:  # by start, then period: only a greater exponent wins
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _hash(text: str) -> str:
    return sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def collapsed(words: list[str], runs: list[Run]) -> list[str]:
    """Words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _rows(ids: list[int | None], texts: list[list[str]]) -> pa.RecordBatch:
    rows = []
    for doc_id, words, runs in zip(ids, texts, runs_of(texts), strict=True):
        start, length, period = _strongest(runs) if runs else (None, None, None)
        exponent = 1000 * length // period if runs else None
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        rows.append((doc_id, len(runs), start, length, period, exponent, _hash(listed), _hash(" ".join(collapsed(words, runs)))))
    kinds = [pa.int64() if kind == "bigint" else pa.string() for kind in _COLUMNS.values()]
    arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(_COLUMNS))


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = made_periodic(doc_id, _WORD.findall(text.as_py() or ""))
            ids.append(doc_id)
            texts.append(words)
            size += len(words)
            if size >= WORDS_AT_ONCE:
                yield _rows(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield _rows(ids, texts)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its runs counted, the strongest one, hashes of all runs and of the collapsed text."""
    return docs.selectExpr("bigint(doc_id) as doc_id", "text").mapInArrow(_work, SCHEMA)
