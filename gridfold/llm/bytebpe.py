"""Ids of a byte-level BPE tokenizer file for whole Arrow columns.

The file's pre-tokenizer is a fixed pattern over character classes, so the bounds of all pre-tokens of a
column come from array operations. Each distinct pre-token is merged once per worker; after that its ids
are a table lookup. Texts that hold the file's special tokens, and files with other pre-tokenizers, go
through the tokenizers library itself.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa

from gridfold.llm.textvec import U, span_hashes

#: Unicode's white space, and the byte-level alphabet's printable ranges.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
PRINTABLE = ((33, 126), (161, 172), (174, 255))
#: What is split off behind an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3
SLICE = 1 << 20


def _classes() -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[list(WHITE)] = BLANK
    return out


def _byte_alphabet() -> dict[str, int]:
    printable = {b for lo, hi in PRINTABLE for b in range(lo, hi + 1)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str, remember: int = 1_500_000) -> None:
        """remember: how many distinct pre-tokens a worker keeps; beyond that it starts anew."""
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer") and spec["model"]["type"] == "BPE"
        self.remember = remember
        if self.plain:
            alphabet = _byte_alphabet()
            extra = {x["content"] for x in spec.get("added_tokens", [])}
            ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in extra}
            self.merge = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
            self.classes = _classes()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _bounds(self, code: np.ndarray, kind: np.ndarray, text_at: np.ndarray) -> np.ndarray:
        """Whether a pre-token begins at each code point. text_at: whether a text does."""
        n = len(code)
        fresh = text_at.copy()
        fresh[1:] |= kind[1:] != kind[:-1]
        ends = np.ones(n, bool)  # the last code point of a run
        ends[:-1] = fresh[1:]
        last_of_text = np.ones(n, bool)
        last_of_text[:-1] = text_at[1:]
        blank = kind == BLANK
        # A run of white space gives its last code point up to what follows it, if anything does.
        single = blank & ends & ~last_of_text
        begin = fresh | single
        # A plain space joins the token behind it.
        joins = single & (code == 0x20)
        begin[1:] &= ~joins[:-1] | text_at[1:]
        quote = np.flatnonzero((code == 0x27) & begin)
        if len(quote):
            padded = np.concatenate([code, np.zeros(3, code.dtype)])
            apart = np.concatenate([text_at, np.ones(3, bool)])
            for tail in CONTRACTIONS:
                hit = quote
                for i, c in enumerate(tail, 1):
                    hit = hit[(padded[hit + i] == ord(c)) & ~apart[hit + i]]
                begin[hit + 1] = False
                after = hit + 1 + len(tail)
                begin[after[after < n]] = True
                if len(hit):
                    quote = np.setdiff1d(quote, hit, assume_unique=True)
        return begin

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids = [self.merge(p.encode()) for p in pieces]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.ids) + np.cumsum(count) - count
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        self.ids = np.concatenate([self.ids, flat])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = np.insert(self.keys, where, keys), np.insert(self.first, where, first), np.insert(self.count, where, count)

    def _vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(code):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        text_at = np.zeros(len(code), bool)
        text_at[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(self._bounds(code, self.classes[code], text_at))
        ends = np.append(starts[1:], len(code))
        distinct, sample, back = np.unique(span_hashes(code, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != distinct if len(self.keys) else np.ones(len(distinct), bool))
        if len(new):
            if len(self.keys) + len(new) > self.remember:
                self._forget()
                new = np.arange(len(distinct))
            self._learn(distinct[new], [joined[starts[i] : ends[i]] for i in sample[new].tolist()])
            at = np.searchsorted(self.keys, distinct)
        at = at[back]
        count = self.count[at]
        stop = np.cumsum(count)
        ids = self.ids[np.arange(int(stop[-1])) + np.repeat(self.first[at] - stop + count, count)]
        row = np.searchsorted(bounds, starts, "right") - 1
        return ids, np.bincount(row, weights=count, minlength=len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, and how many are each text's."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        odd = [i for i, x in enumerate(texts) if not self.plain or any(s in x for s in self.special)]
        if not odd:
            out = [self._vectors(part) for part in _slices(texts)]
            return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
        by_library = {i: np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in odd}
        rest = [x for i, x in enumerate(texts) if i not in by_library]
        ids, count = self.encode(rest) if rest else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        parts = iter(np.split(ids, np.cumsum(count)[:-1])) if rest else iter(())
        rows = [by_library[i] if i in by_library else next(parts) for i in range(len(texts))]
        return np.concatenate(rows), np.array([len(x) for x in rows], np.int64)


def _slices(texts: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    size = 0
    for x in texts:
        if size + len(x) > SLICE and out[-1]:
            out.append([])
            size = 0
        out[-1].append(x)
        size += len(x)
    return out


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """One table of learned pre-tokens for each worker and file."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
