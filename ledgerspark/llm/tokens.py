"""Token ids of whole texts with public tokenizers, through a store of pieces in arrays.

Both vocabularies split a text at blanks before they merge pairs, so the ids of a text are the
ids of its blank-separated pieces one after the other. Pieces repeat; texts hardly do. Pieces go
by 64-bit hashes of their bytes, which are looked up for a whole run of texts at a time; only
pieces not seen before are encoded, all in one string. Texts for which the cut could matter
(other white space, runs of blanks, special tokens' strings) are encoded whole, as the library
does by default.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa

from ledgerspark.llm.hashing import SAME, mix, utf8, word_hashes

#: Pieces kept per Python worker and kind of tokenizer, in about 40 bytes each, twice that while some are added.
CACHE = 1_500_000
#: Pieces encoded in one string.
LEARN = 4096
#: Stands between the pieces that are encoded to learn them; never part of a piece.
MARK = "\x01"

_CUTS = np.zeros(256, bool)
_CUTS[[10, 32]] = True
_LINE = np.uint64(0xD6E8FEB86659FD93)


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the elements of runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Store:
    """Ids by hash: two sorted arrays of hashes, of which the smaller takes what is new."""

    def __init__(self):
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.levels = [none, none]
        self.ids, self.bounds = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)  # found again after the run of texts that brought it

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for those not in the store."""
        out = np.full(len(hashes), -1)
        for keys, numbers in self.levels:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, numbers[at], out)
        self.met[out[out >= 0]] = True
        return out

    def repeated(self, most: int) -> Store:
        """The pieces that were found again; none if they are more than ``most``."""
        out, kept = Store(), np.flatnonzero(self.met)
        if 0 < len(kept) <= most:
            hashes = np.empty(len(self), np.uint64)
            for keys, numbers in self.levels:
                hashes[numbers] = keys
            sizes = np.diff(self.bounds)[kept]
            out.add(hashes[kept], self.ids[_expand(self.bounds[kept], sizes)], sizes)
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self)
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.met = np.concatenate([self.met, np.zeros(len(sizes), bool)])
        large, small = self.levels
        small = np.concatenate([small[0], hashes]), np.concatenate([small[1], np.arange(first, len(self))])
        if len(small[0]) > 50_000 + len(large[0]) // 4:
            large = np.concatenate([large[0], small[0]]), np.concatenate([large[1], small[1]])
            small = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            order = np.argsort(large[0])
            large = large[0][order], large[1][order]
        else:
            order = np.argsort(small[0])
            small = small[0][order], small[1][order]
        self.levels = [large, small]


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, most: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_blanks = self.tokenizer.normalizer is not None
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.store = most, Store()
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        if self.drops_blanks:
            self.begins[self._ids(MARK)] = True
        else:  # a blank or a line feed stands first in its token and first in a piece
            self.begins[[i for t, i in vocabulary.items() if t[0] in "ĠĊ"]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Encodes pieces, a few thousand in one string, as the library needs far more memory than the ids."""
        ids, sizes = zip(*(self._encoded(pieces[at:at + LEARN]) for at in range(0, len(pieces), LEARN)))
        self.store.add(hashes, np.concatenate(ids), np.concatenate(sizes))

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has; those of a vocabulary with blanks have theirs in front."""
        if self.drops_blanks:
            ids = self._ids("".join(f" {MARK} {p}" for p in pieces))
            at = np.flatnonzero(self.begins[ids])
            starts, stops = at + 1, np.append(at[1:], len(ids))
        else:
            ids = self._ids("".join(pieces))
            starts = np.flatnonzero(self.begins[ids])
            stops = np.append(starts[1:], len(ids))
        if len(starts) != len(pieces):
            raise ValueError("pieces do not come back one by one")
        return ids[_expand(starts, stops - starts)], stops - starts

    def _is_cut(self, text: str) -> bool:
        """Whether a text may be cut at its blanks; else it must be encoded whole."""
        if any(s in text for s in self.specials):
            return False
        if not (text if text.isascii() and "\n" not in text else text.replace("\n", "")).isprintable():
            return False
        if self.drops_blanks:
            return True
        return not ("  " in text or "\n " in text or " \n" in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        cut = np.array([bool(t) and self._is_cut(t) for t in texts], bool)
        out = [b"" if c or not t else self._ids(t).tobytes() for t, c in zip(texts, cut.tolist())]
        if not cut.any():
            return out
        rows = np.flatnonzero(cut)
        raw, bounds = utf8(pa.array([texts[i] for i in rows.tolist()], pa.large_string()))
        folds = self.drops_blanks and bool((raw < 128).all())  # this vocabulary lowers letters
        fold = {} if folds else {"fold": SAME}
        hashes, words = word_hashes(raw, bounds, _CUTS, **fold)
        start, stop = self._places(raw, bounds)
        if not self.drops_blanks:  # the first word of a text stands as if after a line feed
            line = np.ones(len(start), bool)
            inner = np.ones(len(start), bool)
            inner[words[:-1]] = False
            line[inner] = raw[start[inner] - 1] == 10
            hashes = np.where(line, mix(hashes ^ _LINE), hashes)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        number = self.store.find(distinct)
        new = np.flatnonzero(number < 0)
        if len(new) and len(self.store) + len(new) > self.most:
            self.store = self.store.repeated(self.most // 2)  # most pieces are met once
            number = self.store.find(distinct)
            new = np.flatnonzero(number < 0)
        if len(new):
            at, data = first[new], raw.tobytes()
            pieces = [data[a:b].decode() for a, b in zip(start[at].tolist(), stop[at].tolist())]
            if self.drops_blanks:
                pieces = [p.lower() for p in pieces] if folds else pieces
            else:
                pieces = [("\n" if n else " ") + p for n, p in zip(line[at].tolist(), pieces)]
            number[new] = np.arange(len(self.store), len(self.store) + len(new))
            self._learn(distinct[new], pieces)
        number = number[which]
        sizes = self.store.bounds[number + 1] - self.store.bounds[number]
        ids = self.store.ids[_expand(self.store.bounds[number], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[words]
        skip = 0 if self.drops_blanks else 1  # the line feed put in front
        for i, a, b in zip(rows.tolist(), ends.tolist(), ends[1:].tolist()):
            out[i] = ids[4 * (a + skip):4 * b] if b > a else b""
        return out

    @staticmethod
    def _places(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words begin and end, in the order of their hashes."""
        word = ~_CUTS[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[bounds] = True
        before = np.concatenate([[False], word[:-1]]) & ~edge[:-1]
        after = np.concatenate([word[1:], [False]]) & ~edge[1:]
        return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    return Encoder(path)
