"""Token ids of texts by a byte-level tokenizer, with a bounded cache of words in each Python worker."""

from __future__ import annotations

import os
import re

import numpy as np

#: Letters, digits and blanks of the characters up to U+024F, control characters and the no-break space left out.
LETTERS, DIGITS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t\n\r "
#: Texts with any other character go to the tokenizer whole.
OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")
#: How byte-level tokenizers cut a text before merging: merges never cross these words.
WORD = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


def _letters_of_bytes() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: visible ones for themselves, the others from U+0100 up in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: 0x100 + k for k, b in enumerate(others)}


class _Words(dict):
    """Ids of words as little-endian unsigned 32-bit values. When full, it becomes the older half, from which words still in use come back."""

    def __init__(self, encode, most: int):
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.encode(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class ByteEncoder:
    """Ids of texts. Strings of special tokens inside a text are ordinary text."""

    def __init__(self, path: str, most_words: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, _letters_of_bytes()
        self.words = _Words(self.word, most_words)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """A word by the tokenizer's merges alone."""
        of_bytes = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(of_bytes)])

    def ids(self, text: str) -> bytes:
        if OTHER.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, WORD.findall(text)))


_encoders: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each tokenizer file in a worker."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]
