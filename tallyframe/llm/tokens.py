"""Token ids of texts by a public tokenizer, with a bounded cache of words in each Python worker."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts with any other character go to the tokenizer whole. Inside this set, normalizing and splitting never look across
#: white space and lower case is one to one, so words can be encoded one by one.
OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ɏ]")
#: Marks that form pieces of their own and are set apart by blanks, unless one stands beside an apostrophe.
MARKS = r"[!-&(-/:-@\[-`{-~¡-©«¬®-±´¶-¸»¿×÷]"
BESIDE = re.compile(f"'{MARKS}|{MARKS}'")
SIMPLE = re.compile(f"[a-zß-öø-ÿ]+|{MARKS}+")


class Encoder:
    """Ids of texts. Strings of special tokens inside a text are ordinary text."""

    def __init__(self, path: str, most_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words: dict[str, bytes] = {}
        self.most = most_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Simple words are encoded many at a time and told apart by the ids that end a word."""
        simple = [w for w in new if SIMPLE.fullmatch(w)]
        for k in range(0, len(simple), 500):
            some = simple[k : k + 500]
            got = self.ids(" ".join(some))
            cuts = np.flatnonzero(self.ends_word[got]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(got):
                raw, bounds = got.tobytes(), [0, *(4 * cuts).tolist()]
                self.words.update(zip(some, (raw[a:b] for a, b in zip(bounds, bounds[1:]))))
        for w in new:
            if w not in self.words:
                self.words[w] = self.ids(w).tobytes()

    def _split(self, texts: list[str]) -> pa.ListArray:
        low = pc.utf8_lower(pa.array(texts, pa.large_string()))
        apart = pc.replace_substring_regex(low, f"({MARKS}+)", r" \1 ")
        close = pa.array([bool("'" in t and BESIDE.search(t)) for t in texts], pa.bool_())
        return pc.utf8_split_whitespace(pc.if_else(close, low, apart))

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and where each text ends."""
        plain = [i for i, t in enumerate(texts) if not OTHER.search(t)]
        split = self._split([texts[i] for i in plain])
        coded = split.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        words = self.words
        missing = [w for w in unique if w not in words and w]
        if missing:
            if len(words) > self.most:
                words.clear()
                missing = [w for w in unique if w]
            self._learn(missing)
        held = [self.words[w] if w else b"" for w in unique]
        blob = np.frombuffer(b"".join(held), np.uint32)
        lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
        starts = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy(zero_copy_only=False)
        counts = lengths[at] if len(at) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = blob[np.repeat(starts[at] - ends[:-1], counts) + np.arange(ends[-1])] if len(at) else np.zeros(0, np.uint32)
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        if len(plain) == len(texts):
            return ids, bounds[1:]
        whole = dict(zip(plain, zip(bounds[:-1], bounds[1:])))
        each = [ids[slice(*whole[i])] if i in whole else self.ids(t) for i, t in enumerate(texts)]
        return np.concatenate([*each, np.zeros(0, np.uint32)]), np.cumsum([len(x) for x in each])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file in a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
