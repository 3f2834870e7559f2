"""Token counts under a unigram vocabulary, without making the tokens.

A word's best segmentation is found by dynamic programming over the vocabulary entries that an
Aho-Corasick automaton reports for each end; only the best score and its number of pieces are kept. Ties
follow the tokenizer: of segmentations with equal scores the one whose last piece starts first wins. A
character that is no entry costs ten more than the worst entry and counts as its bytes. Words are
independent (no entry crosses a space), so each worker remembers the counts of the words it has met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"  # stands for a space, at the beginning of a word
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """Entries and scores of a vocabulary file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounts(dict):
    """Number of pieces per word (the space before it is implied); computed when first asked for."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for entry, score in vocabulary:
            if entry:
                self.matches.add_word(entry, (len(entry), float(score)))
        self.matches.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = self.best(SPACE + word)[1]
        return found

    def best(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best segmentation."""
        n, unknown = len(text), self.unknown
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        end, top, many, single = 0, 0.0, 0, True
        for last, (length, score) in self.matches.iter(text):
            if last >= end:  # matches of a new end; longest first, so their starts ascend
                while True:
                    if end and not single:
                        other = scores[end - 1] + unknown
                        if top is None or other > top:
                            top, many = other, counts[end - 1] + len(text[end - 1].encode())
                    scores[end], counts[end] = top, many
                    end += 1
                    top, many, single = None, 0, False
                    if end > last:
                        break
            start = end - length
            score += scores[start]
            if top is None or score > top:
                top, many = score, counts[start] + 1
            if length == 1:
                single = True
        while True:
            if end and not single:
                other = scores[end - 1] + unknown
                if top is None or other > top:
                    top, many = other, counts[end - 1] + len(text[end - 1].encode())
            scores[end], counts[end] = top, many
            if end == n:
                return top, many
            end += 1
            top, many, single = None, 0, False


_known: dict[str, PieceCounts] = {}


def piece_counts(path: str) -> PieceCounts:
    if path not in _known:
        _known[path] = PieceCounts(unigram_vocabulary(path))
    return _known[path]


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every row of ``docs``.

    A space begins a word, and one is put before the text unless it has one. Null and empty texts have no
    tokens. Rows are counted one by one: ids that are null or repeat make no difference. Other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = piece_counts(vocabulary)
        for batch in batches:
            out = np.zeros(len(batch), dtype=np.int64)
            for i, one in enumerate(batch.column(1)):
                words = (one.as_py() or "").replace(SPACE, " ").split(" ")
                if not words[0]:
                    del words[0]
                out[i] = sum(map(of_word.__getitem__, words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "n_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string"))
    return own.mapInArrow(run, f"doc_id {kind}, n_tokens long").withColumnRenamed("doc_id", doc_id)
