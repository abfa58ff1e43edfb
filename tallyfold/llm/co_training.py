"""Quality and toxicity of documents by co-training.

Method: two views of a document, each with its own classifier. The content view is which words occur
in the text. The metadata view is what is known without reading it: source, language, stated length,
and the shape of the page (lines, line repeats, marks, digits, capitals, mean word length). A
classifier is a naive Bayes sum of log ratios over the traits present; words count only where a
likelihood-ratio test ties them to the class. Both start from the labelled documents. In each round
either view scores every unlabelled document, and those it is surest of (log odds of ``SURE`` at
least), in the proportions of the labels, are labelled for the other view, which is made anew from
the labelled documents and these.
The share taken grows to ``share`` in the last round; ties at its edge go by a hash of the document.
All pseudo-labels together weigh at most as much as the labelled documents, whatever the corpus. At
last both are calibrated on labelled documents held out (Platt scaling), and what each adds to the
log odds of the class is summed, as views that are independent given the class allow.

Bound (a parameter): at most ``max_labelled`` labelled documents, those of the smallest hashes of
their ids, give labels; labelled documents beyond them count as unlabelled. Nothing else is bounded:
all unlabelled documents take part in every round.

Defined results: a NULL or empty text has an empty content view; a document without an id is scored
but never trains; of several labels of an id the highest counts, and its longest text; without labels,
or with one class only, every score is 0.5 and every document is kept; copies (alike in text and
metadata) are one document in the exchange; repeated rows each get a row. Other columns are ignored,
missing metadata counts as a value of its own.

At scale: texts are read once and not shuffled. Traits are hashed and stored, 4 bytes for each
different word of a document. A round is two passes over them: numbers of documents per step of the
score give the edges; the chosen documents add up to whole-number counts per trait, which do not
depend on partitions or on tasks run twice. The driver holds counts of ``CONTENT`` traits and the
labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.near_duplicates import WordHashes
from tallyfold.sources.shared import stored

CONTENT = 1 << 18
META = 1 << 9
MAX_LABELLED = 4000
ROUNDS = 3
SHARE = 0.1
TARGETS = ("quality", "toxic")
VIEWS = (("content", CONTENT, 16.0), ("meta", META, 0.0))  # column, traits, least likelihood ratio of a trait
STEPS = 64  # steps of a score per nat
SURE = 3.0  # least log odds, either way, of a pseudo-label (a probability of 0.95)
_VIEW = ["doc_id", "text", "lang", "source", "n_chars"]


def content_view(text: str, hashes: WordHashes) -> np.ndarray:
    words = set(text.lower().split())
    return np.unique((np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)) % np.uint64(CONTENT)).astype(np.int32))


def metadata_view(text: str, lang, source, n_chars, hashes: WordHashes) -> np.ndarray:
    """Every trait is a bin of its own, so missing values and odd scales need no care."""
    lines, size = text.split("\n"), max(1, len(text))
    n_words = max(1, len(text.split()))
    marks = sum(map(text.count, "#*$%&|<>"))
    traits = [
        f"lang {lang}",
        f"source {source}",
        f"stated {None if n_chars is None else int(np.log2(max(1, n_chars)) * 2)}",
        f"length {int(np.log2(size) * 2)}",
        f"lines {int(np.log2(len(lines)) * 2)}",
        f"repeats {int(10 * (1 - len(set(lines)) / len(lines)))}",
        f"marks {int(np.log2(1 + 1000 * marks / size) * 2)}",
        f"digits {int(np.log2(1 + 1000 * sum(map(text.count, '0123456789')) / size) * 2)}",
        f"capitals {int(np.log2(1 + 1000 * sum(map(str.isupper, text)) / size) * 2)}",
        f"words {int(2 * size / n_words)}",
        f"stops {int(np.log2(1 + 100 * text.count('.') / n_words) * 2)}",
    ]
    return np.unique(np.array([hashes[trait] % META for trait in traits], np.int32))


class Counts:
    """Documents of either class, in all and by trait; classes are 0 and 1."""

    def __init__(self, traits: int):
        self.documents, self.by_trait = np.zeros(2), np.zeros((2, traits))

    def add(self, label: int, rows: list[np.ndarray]) -> Counts:
        self.documents[label] += len(rows)
        for row in rows:
            self.by_trait[label, row] += 1
        return self

    def with_pseudo(self, other: Counts) -> Counts:
        """Sum in which the other documents weigh at most as much as these."""
        weight = min(1.0, self.documents.sum() / max(1.0, other.documents.sum()))
        both = Counts(self.by_trait.shape[1])
        both.documents = self.documents + weight * other.documents
        both.by_trait = self.by_trait + weight * other.by_trait
        return both


def weights(counts: Counts, least: float, prior: float = 1.0) -> np.ndarray:
    """Log ratio of each trait between the classes, 0 where its likelihood ratio is below ``least``."""
    n, by_trait = counts.documents, counts.by_trait
    share = by_trait.sum(0) / n.sum()
    ratio = np.zeros(by_trait.shape[1])
    for label in (0, 1):
        for seen, expected in ((by_trait[label], n[label] * share), (n[label] - by_trait[label], n[label] * (1 - share))):
            some = seen > 1e-9
            ratio[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    found = np.log((by_trait + prior * np.maximum(share, 1e-12)) / (n[:, None] + prior))
    return np.where((share > 0) & (ratio >= least), found[1] - found[0], 0.0)


def platt(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn raw scores into log odds: Newton steps on standard scores, with a little shrinkage."""
    middle, spread = raw.mean(), max(1e-9, raw.std())
    x = np.stack([(raw - middle) / spread, np.ones_like(raw)])
    pull = np.array([0.01, 1e-6])

    def loss(at: np.ndarray) -> float:
        odds = at @ x
        return float((np.logaddexp(0, odds) - labels * odds).sum() + (pull * at**2).sum() / 2)

    at = np.array([0.0, np.log(labels.mean() / (1 - labels.mean()))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + np.diag(pull), x @ (p - labels) + pull * at)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = max(0.0, float(at[0])) / spread
    return slope, float(at[1]) - slope * middle


class View:
    """Classifier of one view with its calibration."""

    def __init__(self, counts: Counts, least: float, held: list[np.ndarray], labels: np.ndarray):
        self.weights = weights(counts, least)
        self.slope, self.offset = platt(np.array([self.weights[row].sum() for row in held]), labels)

    def odds(self, traits: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Log odds of each row; sums go by row, so they do not depend on the batch."""
        return self.slope * np.bincount(owner, self.weights[traits], rows) + self.offset


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists, and the row of each."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), sizes)


def _batch_odds(batch: pa.RecordBatch, models: dict) -> dict:
    """Log odds by (target, place of the view) of the rows of a batch."""
    lists = [_lists(batch.column(name)) for name, _, _ in VIEWS]
    return {(t, v): model.odds(*lists[v], batch.num_rows) for t, pair in models.items() for v, model in enumerate(pair)}


def steps(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(odds * STEPS), -(1 << 15), 1 << 15).astype(np.int32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed traits of both views; texts stay behind."""
    hashes = WordHashes()
    for batch in batches:
        views: list[list[np.ndarray]] = [[], []]
        for row in zip(*[batch.column(name) for name in _VIEW[1:]]):
            text, *rest = [value.as_py() for value in row]
            views[0].append(content_view(text or "", hashes))
            views[1].append(metadata_view(text or "", *rest, hashes))
        lists = [pa.array(view, pa.list_(pa.int32())) for view in views]
        yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in ("doc_id", "same", "size")], *lists], ["doc_id", "same", "size", "content", "meta"])


_FEATURES = "doc_id bigint, same bigint, size bigint, content array<int>, meta array<int>"


def features(docs: DataFrame) -> DataFrame:
    """Hashed traits of every document; ``same`` is equal for copies."""
    narrow = docs.selectExpr("bigint(doc_id) as doc_id", "text", "lang", "source", "bigint(n_chars) as n_chars")
    known = narrow.selectExpr("*", "xxhash64(text, lang, source, n_chars) as same", "bigint(coalesce(length(text), 0)) as size")
    return known.mapInArrow(_featured, _FEATURES)


def _edge(counts: np.ndarray, wanted: int) -> tuple[int, float]:
    """First place of ``counts`` that is not taken whole, and the share of it that makes up ``wanted``."""
    reached = np.cumsum(counts)
    at = int(np.searchsorted(reached, wanted))
    if at >= len(counts):
        return at, 0.0
    return at, float((wanted - (reached[at] - counts[at])) / counts[at])


def edges(counted: dict[int, int], share: float, prior: float) -> list[tuple[int, float]]:
    """For class 0 and 1 the step of the score where its share of documents ends, and how much of that step belongs to it.

    ``counted`` is the number of documents by step. A class takes only documents whose log odds reach ``SURE`` its way.
    """
    total, found, sure = sum(counted.values()), [], int(SURE * STEPS)
    for label, part in ((0, 1 - prior), (1, prior)):
        own = sorted((step for step in counted if (step >= sure if label else step < -sure)), reverse=label == 1)
        at, rest = _edge(np.array([counted[step] for step in own], np.int64), round(share * part * total))
        # One step beyond the last if all of them are taken.
        beyond = (own[-1] + (1 if label == 0 else -1)) if own else (-(1 << 20) if label == 0 else 1 << 20)
        found.append((own[at], rest) if at < len(own) else (beyond, 0.0))
    return found


def chosen_rows(odds: np.ndarray, same: np.ndarray, edge: tuple[int, float], label: int) -> np.ndarray:
    """Whether a class takes a document; documents at the edge go by their hash."""
    step = steps(odds)
    lot = (same.view(np.uint64) >> np.uint64(32)) / 2.0**32
    return ((step > edge[0]) if label else (step < edge[0])) | ((step == edge[0]) & (lot < edge[1]))


def _stepped(models: dict):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_odds(batch, models)
            columns = [pa.array(steps(odds)) for odds in found.values()]
            yield pa.RecordBatch.from_arrays([batch.column("same"), *columns], ["same", *[f"{t}{v}" for t, v in found]])

    return work


def _labelled_for_other(models: dict, ends: dict):
    """Rows (copy hash, key, traits in the other view) of the documents that a view is surest of."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, place = batch.column("same"), 0
            for (target, view), odds in _batch_odds(batch, models).items():
                for label in (0, 1):
                    rows = np.flatnonzero(chosen_rows(odds, same.to_numpy(), ends[target, view][label], label))
                    taken = batch.take(pa.array(rows))
                    key = pa.array(np.full(len(rows), place + label, np.int32))
                    yield pa.RecordBatch.from_arrays([taken.column("same"), key, taken.column(VIEWS[1 - view][0])], ["same", "key", "traits"])
                place += 2

    return work


def exchange(pool: DataFrame, models: dict, priors: dict, share: float) -> dict:
    """Counts of the pseudo-labelled documents, by (target, place of the view that learns from them)."""
    names = [(t, v) for t in models for v in (0, 1)]
    stepped = pool.mapInArrow(_stepped(models), "same bigint, " + ", ".join(f"{t}{v} int" for t, v in names)).dropDuplicates(["same"])
    every = ", ".join(f"struct({place} as place, {t}{v} as step)" for place, (t, v) in enumerate(names))
    numbers: dict = {name: {} for name in names}
    for row in stepped.selectExpr(f"inline(array({every}))").groupBy("place", "step").count().collect():
        numbers[names[row.place]][row.step] = row["count"]
    ends = {name: edges(numbers[name], share, priors[name[0]]) for name in names}
    taken = pool.mapInArrow(_labelled_for_other(models, ends), "same bigint, key int, traits array<int>").dropDuplicates(["same", "key"])
    # A row -1 per document counts the documents themselves.
    traits = taken.selectExpr("key", "explode(array_append(traits, -1)) as trait").groupBy("key", "trait").count().toArrow()
    keys, trait, n = (traits.column(name).to_numpy() for name in ("key", "trait", "count"))
    found = {}
    for place, (target, view) in enumerate(names):
        counts = found[target, 1 - view] = Counts(VIEWS[1 - view][1])
        for label in (0, 1):
            own = keys == 2 * place + label
            counts.documents[label] = n[own & (trait < 0)].sum()
            counts.by_trait[label, trait[own & (trait >= 0)]] = n[own & (trait >= 0)]
    return found


def _labelled(stored_features: DataFrame, chosen: DataFrame) -> list:
    """Traits and labels of the sample, in an order that depends on ids only; the longest text of an id counts."""
    held = stored_features.join(F.broadcast(chosen), "doc_id").groupBy("place", "doc_id", *TARGETS)
    rows = held.agg(F.expr("max(struct(size, same, content, meta)) as d")).selectExpr("place", "doc_id", *TARGETS, "d.content", "d.meta")
    return sorted(rows.collect(), key=lambda row: (row.place, row.doc_id))


def train(stored_features: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, share: float = SHARE) -> dict:
    """A pair of views and the log odds of the class, for each target of which both classes are known."""
    best = labels.selectExpr("bigint(doc_id) as doc_id", *TARGETS).filter("doc_id is not null")
    best = best.groupBy("doc_id").agg(*[F.max(t).cast("int").alias(t) for t in TARGETS])
    chosen = stored(best.selectExpr("*", "xxhash64(doc_id) as place").orderBy("place", "doc_id").limit(max_labelled), "labelled")
    rows = _labelled(stored_features, chosen)
    own, held, known, priors = {}, {}, {}, {}
    for target in TARGETS:
        some = [row for row in rows if row[target] is not None]
        out = some[4::5]  # held out for the calibration
        given = [row for place, row in enumerate(some) if place % 5 != 4]
        if len({row[target] > 0 for row in given}) < 2 or len({row[target] > 0 for row in out}) < 2:
            continue
        known[target] = np.array([float(row[target] > 0) for row in out])
        priors[target] = float(np.mean([row[target] > 0 for row in given]))
        for v, (name, size, _) in enumerate(VIEWS):
            counts = own[target, v] = Counts(size)
            for label in (0, 1):
                counts.add(label, [np.array(row[name], np.int64) for row in given if (row[target] > 0) == bool(label)])
            held[target, v] = [np.array(row[name], np.int64) for row in out]

    def views(counts: dict) -> dict:
        return {t: [View(counts[t, v], VIEWS[v][2], held[t, v], known[t]) for v in (0, 1)] for t in known}

    models = views(own)
    pool = stored_features.filter("doc_id is not null").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    for n in range(rounds if models else 0):
        learned = exchange(pool, models, priors, share * (n + 1) / rounds)
        models = views({key: counts.with_pseudo(learned[key]) for key, counts in own.items()})
    return {t: (models[t], float(np.log(known[t].mean() / (1 - known[t].mean())))) for t in models}


def _scorer(trained: dict):
    models = {target: pair for target, (pair, _) in trained.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds, scores = _batch_odds(batch, models), []
            for target in TARGETS:
                if target in trained:
                    both = odds[target, 0] + odds[target, 1] - trained[target][1]
                    scores.append(1 / (1 + np.exp(-np.clip(both, -30, 30))))
                else:
                    scores.append(np.full(batch.num_rows, 0.5))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, scores)], ["doc_id", *TARGETS])

    return work


def scored(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, share: float = SHARE) -> DataFrame:
    """One row per document: probabilities of quality and toxicity, and whether it is kept."""
    traits = stored(features(docs), "traits")
    trained = train(traits, labels, max_labelled, rounds, share)
    found = traits.mapInArrow(_scorer(trained), "doc_id bigint, quality double, toxic double")
    return found.selectExpr("doc_id", "quality as quality_score", "toxic as toxic_score", "quality >= 0.5D and toxic <= 0.5D as kept")
