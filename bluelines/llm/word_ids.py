"""Token ids of whole texts, word by word over Arrow columns.

A chunk of texts is split at ASCII white space, its words are dictionary-encoded, only words not seen before
go to the tokenizer, and the ids of all texts are laid out with array indexing. That gives the ids of the whole
text because this kind of tokenizer never joins across white space; a probe checks it when the file is opened,
and any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20  # bytes of text encoded together
KNOWN_WORDS = 180_000  # beyond these the words met in one chunk only are forgotten
NEW_WORDS = 8_000  # new words encoded together


class WordIds:
    """Tokenizer of one file with the ids of known words: ``slot`` names a word, ``first`` and ``count`` its ids."""

    PLAIN = re.compile(r"[a-zß-öø-ÿ]+")  # letters that normalizing leaves alone
    MARKED = re.compile(r"([a-zß-öø-ÿ]+)([.,;:?!])")  # the mark is a word of its own to the tokenizer
    PROBE = "The ähnlich Éa, 'twas it's naïve x9 thing's <end> stion! eau; eau mentlevi."

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known_words = Tokenizer.from_file(path), known_words
        # for plain words normalizing and the pattern of words change nothing, so a short way does
        self.short = Tokenizer(self.tokenizer.model)
        self.short.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = "<u2" if len(vocabulary) <= 1 << 16 else "<u4"
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()
        whole = self._whole(self.PROBE)
        self.by_word = np.array_equal(whole, np.concatenate([self._whole(w) for w in self.PROBE.lower().split()]))
        if self.by_word:
            self.by_word = np.array_equal(whole, self.encode(pa.array([self.PROBE]))[0])
            self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.first, self.count, self.met = (np.zeros(1024, np.int64) for _ in range(3))
        self.ids, self.used = np.zeros(4096, self.dtype), 0

    def _make_room(self) -> None:
        """Keeps the words met in at least two chunks (none, if that is more than half of all)."""
        kept = np.flatnonzero(self.met[:len(self.slot)] > 1)
        words = list(self.slot)
        first, count, met = self.first[kept], self.count[kept], self.met[kept]
        ids = self._gather(first, count)
        self._forget()
        if 2 * len(kept) <= self.known_words:
            self._store([words[k] for k in kept], ids, count)
            self.met[:len(kept)] = met // 2

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _store(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.slot)
        if n + len(words) > len(self.first):
            room = 2 * (n + len(words))
            self.first, self.count, self.met = (np.resize(x, room) for x in (self.first, self.count, self.met))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.first[n:n + len(words)] = self.used + np.cumsum(counts) - counts
        self.count[n:n + len(words)] = counts
        self.met[n:n + len(words)] = 0
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.slot.update(zip(words, range(n, n + len(words))))

    def _learn(self, new: list[str]) -> None:
        """Plain words are encoded as one text, cut after the ids that end a word; others one by one."""
        plain, marked, other = [], [], []
        for w in new:
            if self.PLAIN.fullmatch(w):
                plain.append(w)
            elif m := self.MARKED.fullmatch(w):
                marked.append(m)
            else:
                other.append(w)
        stems = {m[1] for m in marked}.difference(self.slot, plain)
        plain.extend(stems)
        other.extend({m[2] for m in marked}.difference(self.slot, other))
        ids = np.array(self.short.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(plain):
            self._store(plain, ids, np.diff(ends, prepend=0))
        else:
            other.extend(plain)
        if other:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
            self._store(other, np.array([i for x in found for i in x], self.dtype), np.array([len(x) for x in found], np.int64))
        if marked:
            slots = np.array([(self.slot[m[1]], self.slot[m[2]]) for m in marked]).ravel()
            counts = self.count[slots]
            self._store([m[0] for m in marked], self._gather(self.first[slots], counts), counts.reshape(-1, 2).sum(axis=1))

    def _gather(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        at = np.repeat(first - (np.cumsum(count) - count), count)
        at += np.arange(len(at))
        return self.ids[at]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text); null counts as empty."""
        column = column.fill_null("")
        # special tokens, whose letters are not lowered, hold "<|"
        apart = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False) if self.by_word else np.ones(len(column), bool)
        texts = pc.if_else(pa.array(apart), "", column) if apart.any() else column
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.slot) > self.known_words:
            self._make_room()
        new = [w for w in words if w not in self.slot]
        for k in range(0, len(new), NEW_WORDS):
            self._learn([w for w in new[k:k + NEW_WORDS] if w not in self.slot] if k else new[:NEW_WORDS])
        distinct = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        self.met[distinct] += 1
        slots = distinct[coded.indices.to_numpy()]
        count = self.count[slots]
        ids = self._gather(self.first[slots], count)
        offsets = split.offsets.to_numpy()
        sizes = np.diff(np.concatenate([[0], np.cumsum(count)])[offsets - offsets[0]])
        if apart.any():
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i in np.flatnonzero(apart):
                parts[i] = self._whole(column[int(i)].as_py())
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, sizes


@lru_cache(2)
def word_ids(path: str, known_words: int = KNOWN_WORDS) -> WordIds:
    return WordIds(path, known_words)


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text."""
    return np.insert(ids, np.cumsum(sizes), end), sizes + 1
