"""Byte-level BPE of whole columns: each distinct piece is encoded once a worker.

A text is cut only where the tokenizer's own pre-tokenizer cuts in any case: at
a white-space run after another character, after a single line feed, and
between a letter and ``.`` or ``,``. None of these lies in a special token's
string, which the tokenizer takes out of a text before. Pieces repeat, so the tokenizers library
encodes the distinct ones, and numpy puts the ids of the texts together. A
piece is known by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from touchline.llm.textbatch import constants, mix, powers, slices, text_bytes

_U = np.uint64
MOST_PIECES = 3 << 19  # the table starts anew beyond these (about 100 MB)
EIGHT = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)  # masks of the first k bytes
AT_ONCE = 2_000  # new pieces encoded at once
ALNUM = np.zeros(256, bool)  # ASCII letters and digits
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def piece_starts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Indices at which a piece starts, all document starts among them."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 1:
        low = data < 0x80
        solid = (data > 0x20) & (data != 0x7F)  # surely no white space, by its last byte
        wide = np.zeros(n, bool)  # last bytes of characters that may be wide spaces
        wide[1:] |= data[:-1] == 0xC2
        wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
        solid &= low | ~wide
        space, feed = data == 0x20, data == 0x0A
        cut[1:] |= (space | feed)[1:] & solid[:-1]
        start = solid | ((data >= 0xC3) & ~((data >= 0xE1) & (data <= 0xE3)))  # surely the first byte of no white space
        start &= low | (data >= 0xC3)
        cut[2:] |= feed[1:-1] & solid[:-2] & start[2:]
        letter = low & (((data | 0x20) >= 97) & ((data | 0x20) <= 122))
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] |= ((data == 0x2C) | (data == 0x2E))[1:] & letter[:-1]
    begin = docs[:-1]
    cut[begin[begin < n]] = True
    return np.flatnonzero(cut)


class Pieces:
    """An open-addressing table from piece hashes to token ids."""

    def __init__(self, tokenizer, dtype):
        self.tokenizer, self.dtype = tokenizer, dtype
        self.values = constants(256, 301)
        self.fwd, self.inv = powers(1 << 16)
        self.nul = tokenizer.encode("\0", add_special_tokens=False).ids[0]
        self.clear()

    def clear(self, log2: int = 17):
        self.size, self.count = 1 << log2, 0
        self.slot = np.full(self.size, -1, np.int32)
        half = self.size // 2
        self.h1, self.h2, self.at, self.n = np.empty(half, _U), np.empty(half, _U), np.empty(half, np.int64), np.empty(half, np.int32)
        self.pool, self.used = np.empty(self.size * 2, self.dtype), 0

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 for those not known."""
        mask = self.size - 1
        where = (h1 & _U(mask)).astype(np.int64)
        entry = self.slot[where]
        wrong = np.flatnonzero((entry >= 0) & ((self.h1[entry] != h1) | (self.h2[entry] != h2)))
        while len(wrong):
            where[wrong] = (where[wrong] + 1) & mask
            e = self.slot[where[wrong]]
            entry[wrong] = e
            wrong = wrong[(e >= 0) & ((self.h1[e] != h1[wrong]) | (self.h2[e] != h2[wrong]))]
        return entry

    def _place(self, entries: np.ndarray):
        mask = self.size - 1
        where = (self.h1[entries] & _U(mask)).astype(np.int64)
        while len(entries):
            free = self.slot[where] < 0
            self.slot[where[free]] = entries[free]  # of several, one stays
            left = self.slot[where] != entries
            entries, where = entries[left], (where[left] + 1) & mask

    def _plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of pieces that NUL may part in one text: none
        holds it, all start with a space, letter or digit and end with a letter
        or digit, so that the pre-tokenizer cuts on both sides of it."""
        flat, n = [], []
        for at in range(0, len(texts), AT_ONCE):
            part = texts[at : at + AT_ONCE]
            whole = self.tokenizer.encode_batch_fast([b"\0".join(part).decode()], add_special_tokens=False)[0].ids
            ids = np.array(whole, self.dtype)
            cut = np.flatnonzero(ids == self.nul)
            assert len(cut) == len(part) - 1
            n.append(np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
            flat.append(ids[ids != self.nul])
        return np.concatenate(flat), np.concatenate(n)

    def _single(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = []
        for at in range(0, len(texts), AT_ONCE):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts[at : at + AT_ONCE]], add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.dtype, int(n.sum())), n

    def add(self, h1: np.ndarray, h2: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        """Encode new pieces, given by their bytes' places, and place them."""
        raw = data.tobytes()
        first, last, before = data[start], data[start + size - 1], data[start + np.maximum(size - 2, 0)]
        wide = (size > 1) & (before == 0xC3) & (last != 0x97) & (last != 0xB7)
        plain = (ALNUM[first] | (first == 0x20) & (size > 1)) & (ALNUM[last] | wide)
        texts = [raw[a:b] for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
        if b"\0" in raw:
            plain &= ~np.array([b"\0" in t for t in texts])
        for chosen, how in ((np.flatnonzero(plain), self._plain), (np.flatnonzero(~plain), self._single)):
            if len(chosen):
                flat, n = how([texts[i] for i in chosen.tolist()])
                self._keep(h1[chosen], h2[chosen], flat, n)

    def _keep(self, h1, h2, flat, n):
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        end = self.count + len(n)
        while 2 * end > self.size:
            grow = lambda x: np.concatenate([x, np.empty_like(x)])
            self.h1, self.h2, self.at, self.n = map(grow, (self.h1, self.h2, self.at, self.n))
            self.size *= 2
            self.slot = np.full(self.size, -1, np.int32)
            self._place(np.arange(self.count, dtype=np.int32))
        new = np.arange(self.count, end, dtype=np.int32)
        self.h1[new], self.h2[new], self.n[new] = h1, h2, n
        self.at[new] = self.used + np.cumsum(n) - n
        self.used, self.count = self.used + len(flat), end
        self._place(new)

    def encode(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other, and offsets per document."""
        if not len(data):
            return np.empty(0, self.dtype), np.zeros(len(docs), np.int64)
        if len(data) > len(self.fwd):
            self.fwd, self.inv = powers(max(1 << 20, len(data)))
        s = piece_starts(data, docs)
        size = np.diff(s, append=len(data))
        with np.errstate(over="ignore"):
            v = self.values[data]
            v *= self.fwd[: len(data)]
            h1 = mix(np.add.reduceat(v, s) * self.inv[s] + size.astype(_U))
            # First and last eight bytes: with the size, all of a piece of up to sixteen.
            eight = np.lib.stride_tricks.as_strided(np.concatenate([data, np.zeros(8, np.uint8)]).view(), (len(data) + 1, 8), (1, 1))
            used = np.minimum(size, 8)
            head = np.ascontiguousarray(eight[s]).view("<u8").ravel() & EIGHT[used]
            tail = np.ascontiguousarray(eight[s + size - used]).view("<u8").ravel() & EIGHT[used]
            h2 = mix(head) + tail * _U(0x9E3779B97F4A7C15)
        entry = self.find(h1, h2)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            if self.count + len(miss) > MOST_PIECES and self.count:
                self.clear()
                miss = np.arange(len(s))
            order = np.lexsort((h2[miss], h1[miss]))
            m = miss[order]
            first = np.ones(len(m), bool)
            first[1:] = (h1[m[1:]] != h1[m[:-1]]) | (h2[m[1:]] != h2[m[:-1]])
            m = m[first]
            self.add(h1[m], h2[m], data, s[m], size[m])
            entry = self.find(h1, h2)
        n = self.n[entry].astype(np.int64)
        run = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = self.pool[np.repeat(self.at[entry] - run[:-1], n) + np.arange(run[-1])]
        return ids, run[np.searchsorted(s, docs)]


def pieces_of(path: str) -> Pieces:
    """The table of this worker: it outlives a task as the library module does."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_encoded_pieces", {})
    if path not in kept:
        t = tokenizers.Tokenizer.from_file(path)
        kept[path] = Pieces(t, np.uint16 if t.get_vocab_size() <= 1 << 16 else np.uint32)
    return kept[path]


def encoder(path: str, end_id: int):
    """Batches (doc_id, text) -> doc_id, ids (little-endian, 2 or 4 bytes each)
    with ``end_id`` after each document; then one row more for each partition,
    without ids, with the ids seen and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        names, kinds = ["doc_id", "ids", "seen", "times"], (pa.list_(pa.int32()), pa.list_(pa.int64()))
        pieces, total = pieces_of(path), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, off = pieces.encode(*text_bytes(part.column("text")))
                ids = np.insert(ids, off[1:], end_id)
                now = np.bincount(ids, minlength=len(total))
                now[: len(total)] += total
                total = now
                off = (off + np.arange(len(off))) * ids.itemsize
                raw = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), raw.cast(pa.binary()), pa.nulls(len(part), kinds[0]), pa.nulls(len(part), kinds[1])], names)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen.tolist()], kinds[0]), pa.array([total[seen].tolist()], kinds[1])], names)

    return run
