"""Count the pieces of a unigram tokenizer without building them.

A text is cut at blanks, and each word gets a blank mark in front, as tokenizers with a
``Metaspace`` pre-tokenizer do. For each distinct word an Aho-Corasick automaton enumerates all
vocabulary pieces in it; dynamic programming over its places carries the best score and the
number of pieces, and nothing else. The rules are those of public unigram tokenizers:

* of segmentations with equal scores that end at a place, that whose last piece is longest wins;
* a character that is no piece by itself may be passed at the least score of the vocabulary less
  10, and counts as one piece per UTF-8 byte if the vocabulary has the byte pieces, else as one
  unknown piece, and neighbouring unknown characters as one.

The vocabulary, some ten thousand pieces, travels with the job; each task builds the automaton once
and keeps the counts of recent words, at most ``REMEMBERED``.

Defined results: a NULL or empty text has no tokens. Texts are counted whole, a word of any length
included. Other columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"            # stands for a blank
UNKNOWN_PENALTY = 10.0
REMEMBERED = 200_000       # words whose counts a task keeps
LONGEST_REMEMBERED = 64    # characters of a word that is kept


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, and whether bytes stand in for unknown characters."""

    pieces: tuple[tuple[str, float], ...]
    bytes_fall_back: bool


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file, scored by rank as p(rank) ~ 1 / (rank + 2).

    The file's own scores are merge ranks, which are no log-probabilities.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = tuple((model.id_to_piece(i), -math.log(i + 2)) for i in range(n))
    return Vocabulary(pieces, any(model.is_byte(i) for i in range(n)))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary.pieces) - UNKNOWN_PENALTY
        self.bytes_fall_back = vocabulary.bytes_fall_back
        self.remembered: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        """Pieces of the best segmentation of a word."""
        best = [0.0] + [-math.inf] * len(word)
        count = [0] * (len(word) + 1)
        unknown_end = [False] * (len(word) + 1)  # the last piece up to here is unknown
        done = 0  # places up to here are final
        single = False

        def close(end: int) -> None:
            """The character before ``end`` may be passed as unknown if it is no piece."""
            if not single:
                score = best[end - 1] + self.unknown
                if score > best[end]:
                    best[end] = score
                    if self.bytes_fall_back:
                        count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "replace"))
                    else:
                        count[end] = count[end - 1] + (not unknown_end[end - 1])
                        unknown_end[end] = True

        # Matches come by end, and for one end the longest first, so a later one must be better.
        for last, (length, piece_score) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:
                close(done + 1)
                done, single = done + 1, False
            start = end - length
            score = best[start] + piece_score
            if score > best[end]:
                best[end], count[end], unknown_end[end] = score, count[start] + 1, False
            single = single or length == 1
        while done < len(word):
            close(done + 1)
            done, single = done + 1, False
        return count[-1]

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:  # a leading blank is the mark that every text starts with
            words = words[1:]
        total, remembered = 0, self.remembered
        for word in words:
            n = remembered.get(word)
            if n is None:
                n = self.pieces(MARK + word)
                if len(word) <= LONGEST_REMEMBERED:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    remembered[word] = n
            total += n
        return total


def count_tokens(documents: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id and n_tokens of every document."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            n = [counter.tokens(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_tokens"])
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long")
