"""Token counts by a count-only Viterbi pass.

The vocabulary of a unigram model stands in an Aho-Corasick automaton, which enumerates all pieces that end at each place
of a word in one sweep. The dynamic program keeps, for each place, the best score and the number of pieces on the best
way there, never the pieces. Ties follow the tokenizer: of equal scores the way that was found first wins, and
ways are found by the start of their last piece; a character without a piece costs ten below the lowest score; unknown
characters in a row are one piece. Words (cut before each space, which is written as a mark) are scored once and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import ahocorasick
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import once
from .shared import Memory, small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words handled together, a bound of memory for long texts.
WORDS_AT_ONCE = 200_000
WORD = regex.compile(f"{MARK}?[^{MARK}]+|{MARK}")


def vocabulary(model: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a model file with their scores; no control, byte, unknown or unused ones."""
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    return [
        (m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
        if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))
    ]


class Counter:
    """Pieces per text under a unigram model."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        for piece, score in pieces:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.unknown = min([0.0] + [score for _, score in pieces]) - UNKNOWN_PENALTY
        self.known = Memory()

    def word(self, word: str) -> int:
        """The number of pieces on the best way through the word."""
        n = len(word)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0

        def settle(place: int, found: list[tuple[int, float]]) -> None:
            best = None
            for size, own in found:  # longest first, that is by start
                total = score[place - size] + own
                if best is None or total > best:
                    best, from_ = total, place - size
            single = bool(found) and found[-1][0] == 1
            if not single and (best is None or score[place - 1] + self.unknown > best):
                score[place], unknown[place] = score[place - 1] + self.unknown, True
                count[place] = count[place - 1] + (not unknown[place - 1])
            else:
                score[place], count[place] = best, count[from_] + 1

        found: list[tuple[int, float]] = []
        for end, piece in self.pieces.iter(word):
            if end + 1 != done + 1 or not found:
                if found:
                    done += 1
                    settle(done, found)
                    found = []
                while done < end:
                    done += 1
                    settle(done, [])
            found.append(piece)
        if found:
            done += 1
            settle(done, found)
        while done < n:
            done += 1
            settle(done, [])
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if text[0] != MARK:
            text = MARK + text
        if len(text) > 4 * WORDS_AT_ONCE:
            words = (m.group() for m in WORD.finditer(text))
            total = 0
            while part := list(islice(words, WORDS_AT_ONCE)):
                total += self._sum(part)
            return total
        first, *rest = text.split(MARK)
        return self._sum([MARK + word for word in rest])

    def _sum(self, words: list[str]) -> int:
        self.known.make_room()
        unseen = [word for word in set(words) if word not in self.known]
        self.known.keep((word, self.word(word)) for word in unseen)
        return sum(map(self.known.__getitem__, words))


def counted(df: DataFrame, model: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """df with the number of pieces of each whole text in column ``into``; a null or empty text has none."""
    small_batches(df.sparkSession)

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = once(("unigram", model), lambda: Counter(vocabulary(model)))
        for batch in batches:
            yield pd.Series([counter.text(t or "") for t in batch], dtype="int64")

    return df.withColumn(into, count(F.col(text)))
