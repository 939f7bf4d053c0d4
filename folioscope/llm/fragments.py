"""Forced-boundary fragments for byte-level BPE.

A byte pair that never occurs side by side inside a vocabulary token can never be joined by a merge,
so a text may be cut between such bytes, every fragment encoded by itself, and the ids concatenated.
Pre-tokenisation adds three conditions, under which a cut leaves the pre-tokens of both sides as they
were: the left character is no white space (``\\s+(?!\\S)`` looks ahead), the right one is no apostrophe
(contractions are matched first at a start), and the right byte starts a character. Bytes of added
tokens count as pairs of the vocabulary, so these are never cut either.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: A fragment of plain form: a line feed or nothing, letters after at most one space, a mark or nothing.
#: Each of the three parts is a pre-token of its own. Letters: ASCII, and U+00C0-00FF without the two signs.
PLAIN = re.compile(rb"(\n(?! )|)( ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([.,;:!?]?)").fullmatch

#: White space of one byte: U+0009-000D, 001C-0020. A cut is not made after it.
SPACES = [*range(0x09, 0x0E), *range(0x1C, 0x21)]
#: Last bytes, and the bytes before these, of longer white-space characters (U+0085, 00A0, 1680, 2000-200A,
#: 2028, 2029, 202F, 205F, 3000). Nor is a cut made after any such two bytes; that only makes cuts rarer.
SPACE_END, SPACE_LEAD = np.zeros(256, bool), np.zeros(256, bool)
SPACE_END[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
SPACE_LEAD[[0x80, 0x81, 0x9A, 0xC2]] = True


def byte_of_char() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies, reversed."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """Bytes of every token id of a byte-level tokenizer file; added tokens stand for their own text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of, vocab = byte_of_char(), spec["model"]["vocab"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (1 + max([*vocab.values(), *added.values()]))
    for token, i in vocab.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    for token, i in added.items():
        out[i] = token.encode()
    return out


def joined(tokens: list[bytes], ids: bytes) -> str:
    """The text of little-endian 32-bit ids, by the bytes of all tokens."""
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """65,536 booleans by ``left << 8 | right``: is a cut between these bytes certain and safe?"""
    seen = np.zeros(65536, bool)
    for t in tokens:
        a = np.frombuffer(t, np.uint8).astype(np.uint16)
        seen[(a[:-1] << 8) | a[1:]] = True
    cut = ~seen.reshape(256, 256)
    cut[SPACES, :] = False
    cut[:, 0x27] = False
    cut[:, 0x80:0xC0] = False
    return cut.reshape(-1)


class Merges:
    """Byte-pair merging of many short fragments at once, by the merge list of the tokenizer file.

    A row of the matrix is a fragment. Each round joins, in every row that has any, the leftmost pair of
    lowest rank, as byte-pair encoding is defined; ranks are looked up in one sorted array of pairs.
    """

    NONE = np.int32(2**31 - 1)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        of = byte_of_char()
        self.start = np.zeros(256, np.int32)
        for c, b in of.items():
            self.start[b] = vocab[c]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.NONE)

    def encode(self, fragments: list[bytes], width: int) -> list[bytes]:
        """Ids of fragments of at most ``width`` bytes, none empty, as little-endian 32-bit integers."""
        n = len(fragments)
        size = np.fromiter(map(len, fragments), np.int64, n)
        data = np.frombuffer(b"".join([f.ljust(width, b"\0") for f in fragments]), np.uint8).reshape(n, width)
        ids = self.start[data]
        ids[np.arange(width) >= size[:, None]] = -1
        rank = np.full((n, width), self.NONE, np.int32)
        rank[:, :-1] = np.where(ids[:, 1:] >= 0, self.ranks(ids[:, :-1], np.maximum(ids[:, 1:], 0)), self.NONE)
        row, out, cols = np.arange(n), ids.copy(), np.arange(width - 1)
        while len(row):
            at = rank.argmin(1)
            every = np.arange(len(row))
            least = rank[every, at]
            live = least < self.NONE
            if not live.all():
                out[row[~live]] = ids[~live]
                row, ids, rank, at, least = row[live], ids[live], rank[live], at[live], least[live]
                every = np.arange(len(row))
                if not len(row):
                    break
            move = cols >= at[:, None] + 1
            ids[every, at] = self.made[least]
            ids[:, :-1] = np.where(move, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            move = cols >= at[:, None]
            rank[:, :-1] = np.where(move, rank[:, 1:], rank[:, :-1])
            rank[:, -1] = self.NONE
            for side in (at - 1, at):
                ok = (side >= 0) & (side + 1 < width)
                a, b = ids[every, np.maximum(side, 0)], ids[every, np.minimum(side + 1, width - 1)]
                ok &= b >= 0
                rank[every[ok], side[ok]] = self.ranks(a[ok], b[ok])
        left = (out >= 0).sum(1)
        flat = out.astype("<u4")
        return [flat[i, :k].tobytes() for i, k in enumerate(left.tolist())]


class Encoder:
    """Encodes texts by their fragments and keeps the ids of short ones in a cache of bounded size.

    Fragments of at most ``longest`` bytes and plain form are merged in bulk by ``Merges``; all others go
    through the library itself, fragment by fragment. The cache starts afresh beyond ``most``.
    """

    #: Bytes of text that are cut into fragments at once.
    BLOCK = 1 << 20

    def __init__(self, path: str, most: int = 200_000, longest: int = 32):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokens = token_bytes(path)
        self.table, self.merges, self.most, self.longest = cut_table(self.tokens), Merges(path), most, longest
        self.single = {b"": b""} | {c: self.by_library(c) for c in map(bytes, zip(b"\n.,;:!?"))}
        self.cache: dict[bytes, bytes] = {}

    def by_library(self, fragment: bytes) -> bytes:
        ids = self.tokenizer.encode(fragment.decode("utf-8"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def learn(self, fragments: list[bytes]) -> None:
        """Adds the ids of new fragments to the cache, plain words in bulk."""
        by_width: dict[int, list[tuple[bytes, bytes, bytes, bytes]]] = {8: [], 16: [], self.longest: []}
        for f in fragments:
            if len(f) <= self.longest and (m := PLAIN(f)):
                by_width[8 if len(m[2]) <= 8 else 16 if len(m[2]) <= 16 else self.longest].append((f, m[1], m[2], m[3]))
            else:
                self.cache[f] = self.by_library(f)
        for width, some in by_width.items():
            for k in range(0, len(some), 20_000):
                part = some[k : k + 20_000]
                for (f, before, _, after), ids in zip(part, self.merges.encode([x[2] for x in part], width)):
                    self.cache[f] = self.single[before] + ids + self.single[after]

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """All ids of each UTF-8 text, as little-endian unsigned 32-bit integers."""
        out, block, held = [], [], 0
        for t in texts:
            block.append(t)
            held += len(t)
            if held >= self.BLOCK:
                out += self._block(block)
                block, held = [], 0
        return out + self._block(block)

    def _block(self, texts: list[bytes]) -> list[bytes]:
        cache, ends, frags = self.cache, [0], []
        for t in texts:
            at = bounds(t, self.table)
            frags += [t[i:j] for i, j in zip(at, at[1:])]
            ends.append(len(frags))
        new = {f for f in frags if f not in cache}
        if len(cache) + len(new) > self.most:
            cache.clear()
            new = set(frags)
        self.learn(list(new))
        ids = list(map(cache.__getitem__, frags))
        for f in new:
            if len(f) > self.longest:
                del cache[f]
        return [b"".join(ids[i:j]) for i, j in zip(ends, ends[1:])]

    def encode(self, data: bytes) -> bytes:
        return self.encode_many([data])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids as ``encode`` returns them; special tokens are kept, broken UTF-8 is replaced."""
        return joined(self.tokens, ids)


def bounds(data: bytes, table: np.ndarray) -> list[int]:
    """Ends of the fragments of ``data``, 0 first; adjacent entries bracket one fragment."""
    if not data:
        return [0]
    a = np.frombuffer(data, np.uint8)
    pairs = a[:-1].astype(np.uint16)
    pairs <<= 8
    pairs |= a[1:]
    at = np.flatnonzero(table[pairs]) + 1
    doubt = at[SPACE_END[a[at - 1]]]
    if len(doubt) and (doubt := doubt[SPACE_LEAD[a[np.maximum(doubt - 2, 0)]]]).size:
        at = np.setdiff1d(at, doubt, assume_unique=True)
    return [0, *at.tolist(), len(data)]
