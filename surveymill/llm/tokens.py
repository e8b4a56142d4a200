"""Token ids of whole texts with a byte-level BPE file of the tokenizers library.

The library spends its time on the same words over and over. A text is therefore cut into the
tokenizer's own word pieces first, each piece is encoded by the library's model once, and its ids are kept. Pieces not seen before go to
the model together, with a byte between them that takes part in no merge. The store has two generations: when the
younger is full it becomes the older, and what is met again in that one moves back, so common pieces outlive
rare ones in any length of input.
Cutting is done here only for texts of plain Latin letters, digits, marks, blanks and line ends,
where the pattern below cuts like the tokenizer; any other text goes through the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import cache

import numpy as np

END_ID = 0
#: Word pieces in a generation of a worker's store (about 250 bytes each).
KEPT_PIECES = 300_000

# The byte-level tokenizer's cut, within the characters that _ODD leaves.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r"!-/:-@\[-`{-~"
_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\s+(?!\S)|\s+"
)
PIECES_TOGETHER = 64  # new pieces that go to the model at a time
_ODD = re.compile(rf"[^{_LETTERS}{_MARKS}0-9 \n]")


def public_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Kept:
    """Values of the keys met lately, in two generations; ``learn`` makes those of new keys."""

    def __init__(self, size: int, learn: Callable[[list[str]], list[bytes]]) -> None:
        self.size, self.learn = size, learn
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, keys: list[str]) -> list[bytes]:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young = self.young
        found = list(map(young.get, keys))
        if None in found:
            places = [i for i, value in enumerate(found) if value is None]
            new = []
            for key in {keys[i] for i in places}:
                value = self.old.get(key)
                if value is None:
                    new.append(key)
                else:
                    young[key] = value
            if new:
                young.update(zip(new, self.learn(new), strict=True))
            for i in places:
                found[i] = young[keys[i]]
        return found


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._model = Tokenizer(self._tokenizer.model)  # without the cut: of pieces as the model spells them
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # how the alphabet writes a blank, a line end and the byte 0, which no piece holds; other ASCII stands for itself
        self._blank, self._line, self._between = (self._bytes(c)[0][0] for c in " \n\0")
        self._between_id = self._tokenizer.token_to_id(self._between)
        holding = [token for token in self._tokenizer.get_vocab(with_added_tokens=False) if self._between in token]
        self._together = PIECES_TOGETHER if holding == [self._between] else 1
        self._pieces = Kept(KEPT_PIECES, self._learn_pieces)

    def _learn_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of new pieces, by the library's model."""
        out = []
        for start in range(0, len(pieces), self._together):
            joined = "\0".join(pieces[start : start + self._together])
            if joined.isascii():
                spelled = joined.replace(" ", self._blank).replace("\n", self._line).replace("\0", self._between)
            else:
                spelled = self._bytes(joined)[0][0]
            ids = np.array(self._model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(ids == self._between_id)).tolist() if self._together > 1 else []
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *(end + 4 for end in ends)], [*ends, len(data)], strict=True)]
        return out

    def encode(self, text: str) -> bytes:
        if _ODD.search(text):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(self._pieces.values(_PIECE.findall(text)))


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it lives as long as the worker."""
    return Encoder(path)
