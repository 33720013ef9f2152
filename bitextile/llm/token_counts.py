"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the pieces gives every match that ends at each character, longest first. For each
character the best score so far and its number of pieces are kept; no path is stored. Ties and unknown characters follow
the unigram model of the `tokenizers` library: a later candidate must score strictly more, so the longest piece wins a
tie; a character that is no piece costs the least score less 10 and counts as its UTF-8 bytes (byte fallback).

Texts are cut as its Metaspace step does: spaces become U+2581, one is put in front, and each begins a segment. A
segment's count depends on nothing else, so a worker keeps the counts of segments it has seen, up to a fixed number.

No file of a unigram model is at hand; the pieces and scores of a SentencePiece file are read as one. Scores of that file
are whole numbers, so sums are exact and ties are common.

Defined results: null and empty texts count 0; repeated rows are counted each; an empty table gives no rows; other columns
are ignored; a very long text is counted by segments, so memory grows with its longest segment alone. Ties: see above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

SPACE, PENALTY, KEPT = "▁", 10.0, 400_000
_made: dict[str, Counter] = {}


def vocabulary(model: str) -> list[tuple[str, float]]:
    """The pieces and scores of a SentencePiece file, in order of their ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    """Counts pieces of segments."""

    def __init__(self, vocab: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocab if len(p) == 1}
        self.unknown = min(s for _, s in vocab) - PENALTY
        self.kept: dict[str, int] = {}

    def segment(self, s: str) -> int:
        n = len(s)
        best, count = [None] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        if self.single.issuperset(s):
            for end, (length, score) in self.automaton.iter(s):
                end += 1
                start = end - length
                score += best[start]
                if best[end] is None or score > best[end]:
                    best[end], count[end] = score, count[start] + 1
            return count[n]
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, (length, score) in self.automaton.iter(s):
            ends[end + 1].append((end + 1 - length, score))
        for end in range(1, n + 1):
            for start, score in ends[end]:
                score += best[start]
                if best[end] is None or score > best[end]:
                    best[end], count[end] = score, count[start] + 1
            if (c := s[end - 1]) not in self.single and (best[end] is None or best[end - 1] + self.unknown > best[end]):
                best[end], count[end] = best[end - 1] + self.unknown, count[end - 1] + len(c.encode("utf-8", "surrogatepass"))
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        parts = text.replace(SPACE, " ").split(" ")
        if not parts[0]:
            del parts[0]
        kept, total = self.kept, 0
        for p in parts:
            n = kept.get(p)
            if n is None:
                n = self.segment(SPACE + p)
                if len(kept) >= KEPT:
                    kept.clear()
                if len(p) <= 64:
                    kept[p] = n
            total += n
        return total


def _count(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    if sent.id not in _made:
        _made[sent.id] = Counter(sent.vocab.value)
    counter = _made[sent.id]
    for batch in batches:
        texts = batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(np.fromiter(map(counter.text, texts), np.int64, len(texts)))],
            ["doc_id", "n_chars", "n_tokens"],
        )


class _Sent:
    def __init__(self, vocab, key: str):
        self.vocab, self.id = vocab, key


def count(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars and n_tokens of each document under the vocabulary in the file `model`."""
    vocab = vocabulary(model)
    sent = _Sent(documents.sparkSession.sparkContext.broadcast(vocab), hashlib.sha256(repr(vocab).encode()).hexdigest())
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"))
    return docs.mapInArrow(lambda b: _count(b, sent), "doc_id long, n_chars long, n_tokens long")
