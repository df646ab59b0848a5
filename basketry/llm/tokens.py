"""Token ids of whole texts, encoded word by word by the tokenizers library.

The vocabularies used here never join characters across certain white space, nor across the end of a
run of letters, so a text may be cut there and its pieces encoded on their own: the ids are those of
the whole text. Pieces repeat, so each distinct one is encoded once and remembered by the task, up to
``MEMORY`` pieces. A run of Latin letters needs no pre-tokenizer and goes straight to the model.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces a task remembers before it starts anew.
MEMORY = 600_000
#: A space before something else: a pre-tokenizer that takes one space into the next word cuts here.
CUT = re.compile(r" (?=\S)")
#: Precomposed Latin letters whose lower case is one letter, up to the end of the run; what follows
#: is ASCII, so that no mark is combined with the last letter.
LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]++(?=[\x00-\x7f]|\Z)")


def strings(values: pa.Array) -> list[str]:
    """The values of a text array without NULLs; ``to_pylist`` would make a scalar of each first."""
    return values.to_numpy(zero_copy_only=False).tolist()


def byte_letters() -> dict[int, str]:
    """The printable characters that byte-level vocabularies write for bytes: themselves where they
    are printable, and the code points from 256 on for the others, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """``spaced``: words keep the space before them; otherwise white space is dropped."""

    def __init__(self, path: str, spaced: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = spaced
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.spans = np.zeros((1 << 14, 2), np.int64)  # start and length; the empty piece has none

    def _letters(self, run: str) -> list[int]:
        """Ids of a run of Latin letters, with a space before it or not."""
        if not self.spaced:
            run = run.lower()
        if not run.isascii() or not self.spaced:
            run = run.encode().decode("latin-1").translate(self.letters)
        else:
            run = run.replace(" ", self.letters[32])
        return [t.id for t in self.model.tokenize(run)]

    def _learn(self, parts: list[str], letters: list[bool]) -> None:
        """Encodes parts that have been given the next places, and keeps their ids."""
        encode = self.tokenizer.encode
        found = [self._letters(p) if run else encode(p, add_special_tokens=False).ids
                 for p, run in zip(parts, letters, strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first, end = len(self.places) - len(parts), self.used + int(sizes.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), end - self.used), np.uint32)])
        if len(self.places) > len(self.spans):
            self.spans = np.concatenate([self.spans, np.zeros((max(len(self.spans), len(parts)), 2), np.int64)])
        self.ids[self.used:end] = np.fromiter(chain.from_iterable(found), np.uint32, end - self.used)
        self.spans[first:len(self.places)] = np.stack([self.used + np.cumsum(sizes) - sizes, sizes], axis=1)
        self.used = end

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Of each piece, the places of its letters and of the rest."""
        if len(self.places) > MEMORY:
            self._forget()
        places, get, match, out = self.places, self.places.get, LETTERS.match, []
        parts: list[str] = []
        kinds: list[bool] = []
        for piece in pieces:
            whole = get(piece)
            if whole is not None:
                out += (whole, 0)
                continue
            run = match(piece)
            cut = run.end() if run else 0
            for part, letters in ((piece[:cut], True), (piece[cut:], False)):
                place = get(part)
                if place is None:
                    place = places[part] = len(places)
                    parts.append(part)
                    kinds.append(letters)
                out.append(place)
        if parts:
            self._learn(parts, kinds)
        return np.array(out, np.int64).reshape(-1, 2)

    def _gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces one after another, number of ids of each)."""
        start, length = self.spans[places.ravel()].T
        ends = np.cumsum(length)
        at = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], length[0::2] + length[1::2]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a NULL text is empty."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ") if self.spaced else pc.ascii_split_whitespace(texts)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        values = lists.flatten()
        coded = values.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        if not self.spaced:
            ids, length = self._gathered(self._places(strings(coded.dictionary))[index])
            return self._by_text(ids, length, ends)
        # What follows a space must begin with something else, or the cut is not one.
        words = coded.dictionary
        plain = pc.invert(pc.or_(pc.equal(words, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(words, 0, 1))))
        pieces = pc.if_else(plain, pc.binary_join_element_wise(pa.scalar(" "), words, pa.scalar("")), "")
        bad = ~plain.to_numpy(zero_copy_only=False)[index]
        heads = ends - sizes
        bad[heads] = False
        places = self._places(strings(pieces) + strings(values.take(pa.array(heads))))
        each = places[:len(words)][index]
        each[heads] = places[len(words):]
        found = self._by_text(*self._gathered(each), ends)
        for row in np.flatnonzero(np.add.reduceat(bad, heads)) if len(heads) else ():
            head, *rest = CUT.split(texts[int(row)].as_py())
            found[row] = self._gathered(self._places([head, *(" " + r for r in rest)]))[0]
        return found

    @staticmethod
    def _by_text(ids: np.ndarray, length: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        cuts = np.concatenate([[0], np.cumsum(length)])[ends]
        return np.split(ids, cuts)[:-1] if len(ends) else []


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The task's encoder; a Python worker keeps it from task to task."""
    key = (path, spaced)
    if key not in _encoders:
        _encoders[key] = Encoder(path, spaced)
    return _encoders[key]
