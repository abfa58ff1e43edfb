"""Token counts of a unigram tokenizer, by dynamic programming on a trie of pre-tokens.

Method: texts are parted into pre-tokens; the different pre-tokens of a batch form a trie whose
edges are bytes. For each node of the trie, which is a prefix shared by all pre-tokens below it, the
score of its best segmentation is computed once, from the scores of the nodes above it (the unigram
forward recursion), together with the number of tokens of that segmentation; the count of a terminal
node is stored for its pre-token. Sorted pre-tokens visit the trie depth first, so the trie is held
as the path to the current node only.

The vocabulary is a file of byte strings and ranks (``VOCABULARY``, a parameter); the log probability
of the piece of rank r is -ln(r + 1) (Zipf's law), as the file has no counts. All single bytes are
pieces, so every text can be segmented. Of equally good segmentations the one with the longest last
piece counts.

Defined results: a NULL or empty text has no tokens; repeated rows each get a row; other columns are
ignored. Concatenated, the pre-tokens are the whole text; a text of any length is one pre-token per
match of the pattern.

At scale: no shuffle at all. The work of a batch is its different pre-tokens; counts of short ones
are kept between batches in a table that is emptied when full.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN = 300_000


def load_pieces(lines) -> dict[bytes, float]:
    """Log probability of each piece, from lines of base64 text and rank."""
    import base64
    import math

    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(piece): -math.log(int(rank) + 1) for piece, rank in pairs}


def trie_counts(tokens: list[bytes], pieces: dict[bytes, float]) -> dict[bytes, int]:
    """Number of tokens of each pre-token. ``tokens`` are different and sorted."""
    longest = max(map(len, pieces))
    found: dict[bytes, int] = {}
    scores, counts, last = [0.0], [0], b""
    for token in tokens:
        shared = len(commonprefix((last, token)))
        del scores[shared + 1 :], counts[shared + 1 :]
        for end in range(shared + 1, len(token) + 1):
            best, count = float("-inf"), 0
            for start in range(max(0, end - longest), end):
                score = pieces.get(token[start:end])
                if score is not None and scores[start] + score > best:
                    best, count = scores[start] + score, counts[start] + 1
            scores.append(best)
            counts.append(count)
        found[token] = counts[-1]
        last = token
    return found


def _counter(file_name: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        with open(SparkFiles.get(file_name), "rb") as lines:
            pieces = load_pieces(lines)
        pattern, known = regex.compile(PATTERN), {}
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                found = [pattern.findall(text or "") for text in part.column("text").to_pylist()]
                fresh = {word for words in found for word in words if word not in known}
                coded = {word: word.encode("utf-8", "surrogatepass") for word in fresh}
                counts = trie_counts(sorted(set(coded.values())), pieces)
                here = {word: counts[code] for word, code in coded.items()}
                here |= {word: known[word] for words in found for word in words if word in known} if known else {}
                n_tokens = [sum(map(here.__getitem__, words)) for words in found]
                if len(known) > KNOWN:
                    known.clear()
                known.update((word, n) for word, n in here.items() if len(word) <= 16)
                arrays = [pa.array(n_tokens, pa.int64()), pa.array(map(len, found), pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *arrays], ["doc_id", "n_bytes", "n_tokens", "n_pretokens"])

    return work


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: bytes, tokens, pre-tokens. The vocabulary file is sent to the executors."""
    docs.sparkSession.sparkContext.addFile(vocabulary)
    narrow = docs.selectExpr("bigint(doc_id) as doc_id", "bigint(coalesce(octet_length(text), 0)) as n_bytes", "text")
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, n_pretokens bigint"
    return narrow.mapInArrow(_counter(vocabulary.rpartition("/")[2]), schema)
