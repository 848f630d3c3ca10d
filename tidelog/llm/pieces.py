"""Pre-tokens of sentence-piece vocabularies.

Such a vocabulary sees a text as one string in which every blank is the mark U+2581,
with one mark put before the text. If no piece has a mark after another character, no
merge reaches from a character that isn't a mark to a mark, so the string falls into
pre-tokens (a run of marks and what follows up to the next mark) whose pieces don't
depend on each other. ``Pieces`` checks that for its vocabulary when it is loaded.

A pre-token is named here by what follows its first mark; encoding that name gives the
pieces of the pre-token, as the library puts a mark before it again.
"""

from __future__ import annotations

import re
from functools import lru_cache

MARK = "▁"
_PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """A sentence-piece model and the split of texts into its pre-tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        if any(MARK in name.lstrip(MARK) for name in names):
            raise ValueError("a piece spans a blank: texts can't be cut into pre-tokens")
        if self.model.encode_as_pieces("a  b ") != [*self.model.encode_as_pieces("a"), *self.model.encode_as_pieces(" b"), MARK]:
            raise ValueError("the model's normaliser changes blanks")
        self.numbers = list(range(size))
        self.is_byte = [self.model.is_byte(i) for i in range(size)]

    def split(self, text: str) -> list[str]:
        """Names of the pre-tokens of ``text``, in order."""
        if not text:
            return []
        if MARK not in text and "  " not in text and text[-1] != " " and text[0] != " ":
            return text.split(" ")
        return [x[1:] for x in _PRE_TOKEN.findall(MARK + text.replace(" ", MARK))]

    def counts(self, names: list[str]) -> list[int]:
        """Number of pieces of each pre-token."""
        return [len(x) for x in self._encode(names)]

    def ids(self, names: list[str]) -> list[list[int]]:
        """Piece ids of each pre-token."""
        return self._encode(names)

    def ids_of(self, name: str) -> tuple[int, ...]:
        """Piece ids of one pre-token; equal ids are one object, so that caches of them stay small."""
        shared = self.numbers
        return tuple([shared[i] for i in (self.model.encode(name) if name else self._encode([name])[0])])

    def _encode(self, names: list[str]) -> list[list[int]]:
        out = self.model.encode(names, num_threads=1)
        for i, name in enumerate(names):
            if not name:  # a lone mark: the library takes an empty text for no text
                out[i] = [self.model.piece_to_id(MARK)]
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The model of a vocabulary file, one for each Python worker."""
    return Pieces(path)
