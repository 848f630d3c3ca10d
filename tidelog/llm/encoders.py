"""Token ids of whole texts, with one model call per distinct pre-token.

The ids equal those of the ``tokenizers`` library for the whole text. A text of plain
Latin characters is split by an equivalent of the vocabulary's rule, and each pre-token
goes through its BPE model once, as long as it stays in a cache of bounded size.
``encode_all`` splits many such texts at once in numpy and looks up each of their
distinct pre-tokens once. Other texts are cut where no pre-token can reach across, and the chunks with other characters
go through the library's whole pipeline:

* byte-level rule: between a character that is not white space and a single blank
  followed by a character that is not white space;
* word rule (white space dropped): at every white space.

Strings of the vocabulary's special tokens in a text are ordinary text (the library's
``encode_special_tokens``), unless ``special_tokens`` asks for the library's own default,
by which they are those tokens: then a text that has one goes through the library whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import MostUsed, TwoGenerations

#: Characters on which the standard library's classes agree with the vocabulary's rules,
#: and which NFC leaves alone.
_PLAIN = re.compile(
    "[\t-\r -~¡-§©«¬®-±¶-¸»¿-įı-ɏ"
    "‐-―‘-‧‰-›]*"
)
_BYTE_RULE = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
_WORD_RULE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SEPARATORS = re.compile("[\x1c-\x1f]")

#: Bytes of texts that :meth:`Encoder.encode_all` splits at once, one long text aside; it takes about twelve times that.
TOGETHER = 1 << 20
#: Pre-tokens that stay in the cache of ``encode_all``: about 300 bytes each.
CACHED = 300_000
_END, _SPACE, _LETTER, _DIGIT, _OTHER = range(5)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point under 2 ** 16, as the rules above see plain characters; NUL, which is none, ends a text."""
    kind = lambda c: _SPACE if c.isspace() else _LETTER if c.isalpha() else _DIGIT if c.isdecimal() else _OTHER
    return np.array([_END, *[kind(chr(i)) for i in range(1, 1 << 16)]], "u1")


def _byte_alphabet() -> list[str]:
    """Character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class Encoder:
    """``encode(text)`` gives the ids as bytes, unsigned little-endian 32-bit each."""

    def __init__(self, path: str, special_tokens: bool = False, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special_tokens else []
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # the caches below take its place
        self.kind = self._kind()
        self.alphabet = {i: c for i, c in enumerate(_byte_alphabet())}
        self.pieces = TwoGenerations(self._piece, most=cached // 2)
        self.often = MostUsed(self._piece, most=cached)
        self.rule = _BYTE_RULE if self.kind == "byte" else _WORD_RULE

    def _kind(self) -> str:
        import json

        spec = json.loads(self.tokenizer.to_str())
        before, split = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        if before is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"):
            return "byte"
        steps = [x["type"] for x in (before or {}).get("normalizers", [])]
        parts = split.get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"]:
            if parts[0]["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
                return "word"
        return "whole"

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece[0] == "\0" or (self.kind == "word" and piece[0].isspace()):
            return b""  # the end of a text, or what the word rule drops
        as_bytes = piece.replace(" ", self.alphabet[32]) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(as_bytes)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join([*map(self.pieces.__getitem__, self.rule.findall(text.lower() if self.kind == "word" else text))])

    def encode(self, text: str) -> bytes:
        if self.kind == "whole" or (self.special and self.special.search(text)):
            return self._library(text)
        if _PLAIN.fullmatch(text):
            return self._plain(text)
        if self.kind == "byte":
            chunks = _CUT.split(text)
        else:
            chunks = [text] if _SEPARATORS.search(text) else text.split()
        return b"".join([self._plain(c) if _PLAIN.fullmatch(c) else self._library(c) for c in chunks])

    def forget(self) -> None:
        """Give the memory of the caches back."""
        self.pieces.clear()
        self.pieces.old = {}
        self.often.clear()

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text (null: empty), in order."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // TOGETHER)) + 1).tolist(), len(texts)]
        for lo, hi in zip(cuts, cuts[1:]):
            some = [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]
            plain = [self.kind != "whole" and bool(_PLAIN.fullmatch(t)) and not (self.special and self.special.search(t)) for t in some]
            found = self._plain_texts([t for t, p in zip(some, plain) if p])
            for i, t in enumerate(some):
                yield next(found) if plain[i] else self.encode(t)

    def _plain_texts(self, texts: list[str]) -> Iterator[bytes]:
        """``_plain`` of each text: all are split at once, and each distinct pre-token is looked up once."""
        whole = "\0".join([*texts, ""])
        points = np.frombuffer((whole.lower() if self.kind == "word" else whole).encode("utf-16-le"), "<u2")
        starts = np.flatnonzero(self._starts(points))
        ends = np.flatnonzero(points[starts] == 0)
        split = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(2 * np.append(starts, len(points))), pa.py_buffer(points)])
        coded = split.dictionary_encode()
        _, offsets, data = coded.dictionary.buffers()
        names = data.to_pybytes().decode("utf-16-le") if data else ""
        at = (np.frombuffer(offsets, "i8", len(coded.dictionary) + 1) // 2).tolist() if len(coded.dictionary) else [0]
        counts = np.bincount(coded.indices, minlength=len(coded.dictionary)).tolist()
        ids = pa.array(self.often.of([names[a:b] for a, b in zip(at, at[1:])], counts), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        last = np.frombuffer(offsets, "i8", len(ids) + 1)[ends].tolist() if len(ids) else []
        for a, b in zip([0, *last], last):
            yield data[a:b].to_pybytes()

    def _starts(self, points: np.ndarray) -> np.ndarray:
        """Whether a pre-token starts at each character; texts end with NUL, which is one, and so are white spaces between words."""
        kind = _classes()[points]
        starts = np.ones(len(points) + 2, bool)
        starts[1 : len(points)] = kind[1:] != kind[:-1]
        starts[:-2][kind == _END] = True
        if self.kind == "word":
            starts[:-2][kind == _DIGIT] = True
        else:  # the last white space before something else stands alone, or goes with that if it is a blank
            last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] > _SPACE))
            starts[last] = True
            starts[last[points[last] == 32] + 1] = False
        quote = np.flatnonzero(points == 39)
        quote = quote[starts[quote] & starts[quote + 1] & (kind[quote + 1] == _LETTER)]
        one, two = points[quote + 1], points[np.minimum(quote + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.isin(one.astype("u4") << 16 | two, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])
        starts[quote[short | long] + 1] = False
        starts[quote[short] + 2] = True
        starts[quote[long] + 3] = True
        return starts[:-2]


@lru_cache(maxsize=2)
def encoder(path: str, special_tokens: bool = False, cached: int = CACHED) -> Encoder:
    """The encoder of a vocabulary file, one for each Python worker."""
    return Encoder(path, special_tokens, cached)
