"""Encoding texts by a public tokenizer, each distinct word once per worker.

`word_bpe_49k.json` drops white space and its pre-tokenizer never crosses it, so a text's ids are
those of its white-space separated words in turn, and words may be looked up. Files named here must
have that property.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of either generation of a worker's cache; what was not used lately goes.
CACHED_WORDS = 250_000

# A word of Latin letters, then stops: two pre-tokens that normalisation never joins.
_WORD_AND_STOPS = re.compile("([a-zß-öø-ÿ]+)([,.!]+)")
# A word of Latin letters is one pre-token that normalisation leaves as it is.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Such words that the tokenizer gets at once, joined by spaces.
JOINED = 100


class WordEncoder:
    """Ids of whole texts, by way of their words."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        vocabulary = self.tokenizer.get_vocab()
        #: Of each id, whether it ends a pre-token.
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.recent: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, and where each text's begin; null is empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = words.flatten()
        # The tokenizer lower-cases; doing so first makes fewer words. Its special tokens, which
        # only match as they are written, all have "<|".
        lowered = pc.if_else(pc.match_substring(flat, "<|"), flat, pc.ascii_lower(flat))
        coded = lowered.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        codes = [self.recent[word] for word in distinct]
        table = np.frombuffer(b"".join(codes), "<u4")
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        starts = np.cumsum(lengths) - lengths

        at = coded.indices.to_numpy(zero_copy_only=False)
        counts = lengths[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = table[np.repeat(starts[at] - ends[:-1], counts) + np.arange(ends[-1])]
        offsets = words.offsets.to_numpy(zero_copy_only=False)
        return ids, ends[offsets - offsets[0]]

    def flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words without white space in turn, and where each word's end."""
        self._learn(words)
        codes = [self.recent[word] for word in words]
        return np.frombuffer(b"".join(codes), "<u4"), np.cumsum(np.fromiter(map(len, codes), np.int64, len(codes)) // 4)

    def forget(self) -> None:
        """Give back the cache's memory."""
        self.recent, self.older = {"": b""}, {}

    def _learn(self, words: list[str]) -> None:
        """Afterwards the recent generation holds all `words`."""
        if len(self.recent) > self.cached:
            self.recent, self.older = {"": b""}, self.recent
        missing = []
        for word in words:
            if word not in self.recent:
                known = self.older.get(word)
                if known is None:
                    missing.append(word)
                else:
                    self.recent[word] = known
        parts = {word: match.groups() for word in missing if (match := _WORD_AND_STOPS.fullmatch(word))}
        wanted = dict.fromkeys(word for word in missing if word not in parts)
        wanted.update(dict.fromkeys(p for pair in parts.values() for p in pair))
        new = [word for word in wanted if word not in self.recent]
        plain = [word for word in new if _LETTERS.fullmatch(word)]
        groups = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
        joined = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, coded in zip(groups, joined, strict=True):
            ids = np.array(coded.ids, "<u4")
            begin, data = 0, ids.tobytes()
            for word, end in zip(group, (4 * np.flatnonzero(self.last[ids]) + 4).tolist(), strict=True):
                self.recent[word] = data[begin:end]
                begin = end
        others = [word for word in new if word not in self.recent]
        for word, coded in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.recent[word] = np.array(coded.ids, "<u4").tobytes()
        for word, (stem, stops) in parts.items():
            self.recent[word] = self.recent[stem] + self.recent[stops]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept while the worker lives."""
    return WordEncoder(path)


def with_end(ids: np.ndarray, begins: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """`ids` with `end_id` after each text's, and where texts begin then."""
    return np.insert(ids, begins[1:], end_id), begins + np.arange(len(begins))
