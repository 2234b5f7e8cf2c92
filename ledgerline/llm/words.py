"""Ids of a lower-casing word BPE tokenizer (``tokenizers`` file), made with the matrix engine of ``bpe``."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .bpe import SPACE, Bpe, PairTable
from .shared import Numbered

#: Fixed: the file's own pattern, with its white space written out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
BREAK = re.compile("[ \n]")  # no id reaches over a space or line break
#: Characters of the texts handled together, and bytes of what each Python worker remembers: bounds of its memory.
CHARACTERS_AT_ONCE = 12 << 20
REMEMBERED_BYTES = 96 << 20


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + others.index(b)) for b in range(256)]


class WordIds:
    """Texts to ids, chunk by chunk. Arrow cuts the texts and numbers their distinct chunks, whose ids stand one after the
    other in one array and are gathered from there; Python sees a distinct chunk once in each group of texts."""

    def __init__(
        self, new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most_bytes: int = REMEMBERED_BYTES,
        characters: int = CHARACTERS_AT_ONCE,
    ):
        """new: the ids of chunks in one array, and how many each has."""
        self.new, self.most_bytes, self.characters = new, most_bytes, characters
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.held = 0
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts go through in groups of about CHARACTERS_AT_ONCE, a longer text in several parts."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        group: list[tuple[int, str]] = []
        held = 0

        def close() -> None:
            nonlocal group, held
            for (number, _), ids in zip(group, self._group([piece for _, piece in group])):
                parts[number].append(ids)
            group, held = [], 0

        for number, text in enumerate(texts):
            for piece in pieces(text, self.characters):
                if group and held + len(piece) > self.characters:
                    close()
                group.append((number, piece))
                held += len(piece)
        close()
        return [own[0] if len(own) == 1 else np.concatenate(own) if own else np.zeros(0, np.int32) for own in parts]

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if self.held > self.most_bytes:
            self._forget()
        column = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        cut = pc.split_pattern(column, " ")
        coded = cut.flatten().dictionary_encode()
        place = pc.index_in(coded.dictionary, self.known).fill_null(-1).to_numpy().astype(np.int64)
        unseen = np.flatnonzero(place < 0)
        if len(unseen):
            place[unseen] = np.arange(len(self.starts), len(self.starts) + len(unseen))
            self._remember(coded.dictionary.take(pa.array(unseen)))
        codes = coded.indices.to_numpy()
        ids, ends = slices(self.flat, self.starts[place], self.sizes[place], codes)
        borders = np.append(0, ends)[cut.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]

    def _remember(self, chunks: pa.Array) -> None:
        flat, sizes = self.new(chunks.to_pylist())
        self.known = pa.concat_arrays([self.known, chunks])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.held = self.known.nbytes + self.starts.nbytes + self.sizes.nbytes + self.flat.nbytes


def slices(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of flat that the codes name, one after the other, and where each ends."""
    size = sizes[codes]
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[codes] - (ends - size), size)
    return flat[at], ends


def pieces(text: str, characters: int) -> Iterator[str]:
    """The text in parts of about so many characters that end before a space or line break, which is left out."""
    start = 0
    while len(text) - start > characters:
        break_ = BREAK.search(text, start + characters)
        if break_ is None:
            break
        yield text[start : break_.start()]
        start = break_.end()
    yield text[start:] if start else text


def word_encoder(path: str) -> WordIds:
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, end = model["vocab"], model["end_of_word_suffix"]
    letters = byte_letters()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    table = np.array([(vocabulary[a], vocabulary[b], i, vocabulary[a + b]) for i, (a, b) in enumerate(merges)], np.int64)
    start = np.array([vocabulary[c] for c in letters])
    start_last = np.array([vocabulary[c + end] for c in letters])
    # Where a pair is listed twice, its first rank counts.
    _, first = np.unique(table[:, 0] << 32 | table[:, 1], return_index=True)
    engine = Bpe(start, start_last, PairTable(*table[first].T))
    split = regex.compile(rf"{PATTERN}|\n")

    def plain(text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # letter by letter, without final sigma

    def new(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(chunks)
        terms = Numbered({"\n": 0})
        found = split.findall(text.lower() if text.isascii() else plain(text))
        codes = np.fromiter(map(terms.__getitem__, found), np.int64, len(found))
        packed = engine.encode([word.encode() for word in islice(terms, 1, None)])
        sizes = np.array([0, *map(len, packed)], np.int64) // 4
        flat, _ = slices(np.frombuffer(b"".join(packed), "<i4"), np.cumsum(sizes) - sizes, sizes, codes)
        chunk = np.cumsum(codes == 0)
        return flat, np.bincount(chunk, sizes[codes], len(chunks)).astype(np.int64)

    return WordIds(new)
