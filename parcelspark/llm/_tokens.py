"""Batch encoding with a public tokenizer file, each distinct piece of text once.

A text is cut where no token can cross: before a single space that a plain
character follows, and between an ASCII letter and common punctuation.  Both kinds
of tokenizer files used here (byte-level BPE; word BPE with word ends) split there
themselves, so the ids of the pieces, joined, are the ids of the text.  No cut falls
inside the name of a special token: as the library does by default, a name in a text
becomes that token's id.  Distinct pieces are encoded once per worker and kept in a
bounded cache.
"""

from __future__ import annotations

import re

import numpy as np
from parcelspark.llm import _text as T

CACHE_PIECES = 1_500_000
STEP = 1 << 20
_AFTER_SPACE = np.zeros(256, bool)
_AFTER_SPACE[0x21:0x7F] = True  # printable ASCII
_AFTER_SPACE[0xC3:0xE0] = True  # two-byte characters from U+00C0 on: none is white space
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ",.;:!?|"]] = True
_PLAIN = re.compile(r" ?[^\s\x00-\x1f\x7f]+")
_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder for each file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.names = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.named = re.compile("|".join(map(re.escape, self.names)) or r"(?!)")
        self.size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        # a separator that is one token of its own between any two plain pieces
        self.sep, self.sep_id = None, -1
        for sep in ("\n", " \x1f "):
            ids = self._raw([sep])[0]
            if len(ids) == 1 and self._raw([f"a b{sep}.c{sep} d"])[0].count(ids[0]) == 2:
                self.sep, self.sep_id = sep, ids[0]
                break
        self._reset()

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _reset(self) -> None:
        self.keys, self.at = np.zeros(0, T.U), np.zeros(0, np.int64)
        self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, sizes, ids): ids of all texts, joined in the given order."""
        plain = [i for i, t in enumerate(texts) if self.sep is not None and _PLAIN.fullmatch(t) and not self.named.search(t)]
        groups = [plain[i : i + 512] for i in range(0, len(plain), 512)]
        order, size, flat, rest = [], [], [], sorted(set(range(len(texts))) - set(plain))
        for g, ids in zip(groups, self._raw([self.sep.join([texts[i] for i in g]) for g in groups]) if groups else [], strict=True):
            ids = np.array(ids, np.int64)
            cut = np.flatnonzero(ids == self.sep_id)
            if len(cut) != len(g) - 1:
                rest += g  # the separator occurs in a piece
                continue
            order += g
            size.append(np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
            flat.append(np.delete(ids, cut))
        for i, ids in zip(rest, self._raw([texts[i] for i in rest]), strict=True):
            order.append(i)
            size.append(np.array([len(ids)]))
            flat.append(np.array(ids, np.int64))
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return np.array(order, np.int64), join(size), join(flat)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        order, n, flat = self._pieces(texts)
        at = np.cumsum(n) - n + len(self.ids)
        self.ids = np.concatenate([self.ids, flat.astype(self.dtype)])
        self.keys, self.at, self.n = np.concatenate([self.keys, keys[order]]), np.concatenate([self.at, at]), np.concatenate([self.n, n])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.at, self.n = self.keys[order], self.at[order], self.n[order]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets per text)."""
        ids, count = [np.zeros(0, self.dtype)], []
        for a, b in T.slices(off, STEP):
            x, c = self._encode(data[off[a] : off[b]], off[a : b + 1] - off[a])
            ids.append(x)
            count.append(c)
        count = np.concatenate(count) if count else np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(count)])

    def _encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(len(off) - 1, np.int64)
        cut = np.zeros(n, bool)
        cut[:-1] = (data[:-1] == 0x20) & _AFTER_SPACE[data[1:]]
        cut[1:] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
        raw = data.tobytes()
        for name in map(str.encode, self.names):
            at = raw.find(name)
            while at >= 0:
                cut[at + 1 : at + len(name)] = False
                at = raw.find(name, at + 1)
        cut[off[:-1][off[:-1] < n]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        doc = np.searchsorted(off, start, side="right") - 1
        keys, first, which = np.unique(T.span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(new := np.flatnonzero(T.in_sorted(keys, self.keys) < 0)):
            if len(self.keys) + len(new) > CACHE_PIECES:
                self._reset()
                new = np.arange(len(keys))
            self._learn(keys[new], [raw[start[i] : end[i]].decode("utf-8", "replace") for i in first[new]])
        at = T.in_sorted(keys, self.keys)[which]
        size, head = self.n[at], self.at[at]
        pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(head, size)
        return self.ids[pos], np.bincount(doc, size, len(off) - 1).astype(np.int64)
