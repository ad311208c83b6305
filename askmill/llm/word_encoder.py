"""Whole texts to token ids through the tokenizers library, each distinct piece encoded once.

A tokenizer that lower-cases, drops white space and splits into words before its merges gives
each piece the same ids wherever it stands. ``PieceEncoder`` cuts such texts itself and asks the
library's model for the ids of pieces it has not seen, several times faster than whole texts. It does so
only for texts made of characters on which the two ways cannot differ; every other text (and
every text under another tokenizer) goes to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

#: Fixed value: the split pattern of the tokenizer files that the short way is meant for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pieces for lower-cased texts of the plain characters below.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_NOT_PLAIN = re.compile(r"[^\t\n\r -~¡-±´-¸º»¿-įı-ɏ–—‘’“”…€]|<\|")


class PieceEncoder:
    """``encode(texts)`` gives one bytes object of little-endian unsigned ids for each text."""

    def __init__(self, path: str, end_id: int | None = None, most_words: int = 700_000):
        self.library = Tokenizer.from_file(path)
        self.wide = self.library.get_vocab_size() > 65536 or (end_id or 0) > 65535
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        self.most_words = most_words
        self.code = "I" if self.wide else "H"
        self.known: dict[str, bytes] = {}
        self.tokenize = self.library.model.tokenize
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        steps = (shape.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        names = [x["type"] for x in (shape.get("normalizer") or {}).get("normalizers") or []]
        self.by_piece = (
            names == ["NFC", "Replace", "Lowercase"]
            and steps[0].get("type") == "Split"
            and steps[0]["pattern"].get("Regex") == SPLIT
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and not shape["post_processor"]
        )

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            shown = piece if piece.isascii() else self.as_bytes.pre_tokenize_str(piece)[0][0]
            ids = [token.id for token in self.tokenize(shown)]
            found = self.known[piece] = array(self.code, ids).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts are cut at white space first, which no piece contains, and words are looked up."""
        cut = [
            None if not self.by_piece or _NOT_PLAIN.search(text) else text.lower().split()
            for text in texts
        ]
        if len(self.known) > self.most_words:
            self.known.clear()
        words, piece = self.known, self._piece
        for word in set().union(*(x for x in cut if x)).difference(words):
            if word.isalpha():
                piece(word)
            elif word[:-1].isalpha() and word[-1] in ".,;:!?":
                words[word] = piece(word[:-1]) + piece(word[-1])
            else:
                words[word] = b"".join(map(piece, _PIECES.findall(word)))
        whole = iter(self._library([t for t, x in zip(texts, cut, strict=True) if x is None]))
        return [
            (next(whole) if x is None else b"".join([words[w] for w in x])) + self.end for x in cut
        ]
