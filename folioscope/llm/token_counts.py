"""Token counts of whole texts by overlap resynchronisation, as the tokenizers library gives them.

A text of more than ``chunk`` characters is encoded in chunks that overlap by ``overlap`` characters, each with the offsets of its
pre-tokens. Two neighbouring chunks are spliced where a pre-token begins in both: the pre-tokeniser reads left to
right and never looks back, so what follows such a place depends on the text to its right alone. The place has to lie
a margin before the end of the left chunk, beyond the reach of the look-ahead and of special tokens, so
that the left chunk's cut can't have made it; that proves it, chunk by chunk from the start of the text. If the overlap
holds no such place (a very long word), it is widened to twice its size, and if it would cover the left chunk, that
chunk is encoded anew at twice its length. So a task holds one chunk's tokens at a time, however long the text.
A text of one chunk is encoded as a whole.

Chunks are read as the library's byte-level pre-tokeniser does: special tokens first, then its published pattern over
classes of characters (letter, number, white space, other). The classes are asked of the library, character by character
as they turn up, and every distinct pre-token is encoded by the library's model and kept in a cache of bounded size. Files of any other form
are encoded chunk by chunk by the library itself, with its offsets.

A null text counts as empty: no bytes, no tokens. Rows are independent: repeated rows and doc_ids, ties and
other columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.fragments import byte_of_char
from folioscope.storage import bounded_batches

CHUNK, OVERLAP, MARGIN = 2048, 64, 32
#: Stand-ins of the classes letter, number, white space and other in the pattern over classes.
STANDS = "A1\t!"


class Classes(dict):
    """Code point to the stand-in of its class, asked of the library's pre-tokeniser."""

    def __init__(self, pre_tokenizer):
        super().__init__()
        self.pieces = lambda text: len(pre_tokenizer.pre_tokenize_str(text))

    def __missing__(self, point: int) -> str:
        c = chr(point)
        letter, number, other = (self.pieces(x + c + x) == 1 for x in "a1!")
        self[point] = STANDS[0 if letter else 1 if number else 3 if other else 2]
        return self[point]


class Encoder:
    """Pre-tokens of a text, by their lengths, and how many tokens each has."""

    def __init__(self, path: str, most: int = 300_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.plain = plain and spec["normalizer"] is None and split.get("type") == "ByteLevel" and bool(split.get("use_regex")) and not split.get("add_prefix_space")
        self.margin = max([MARGIN, *[len(t["content"]) + 2 for t in added]])
        self.cache, self.most, self.longest = {}, most, longest
        if self.plain:
            self.tokenize, self.letters = self.tokenizer.model.tokenize, {b: c for c, b in byte_of_char().items()}
            special = sorted((t["content"] for t in added), key=len, reverse=True)
            self.special = re.compile(f"({'|'.join(map(re.escape, special)) or '(?!)'})")
            self.classes = Classes(self.tokenizer.pre_tokenizer)
            blank = re.escape("".join(chr(i) for i in range(128) if self.classes[i] == STANDS[2]))
            self.classes.update({i: chr(i) for i in range(128)})
            self.split = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^{blank}A-Za-z0-9]+|[{blank}]+(?![^{blank}])|[{blank}]+").findall

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if text.isascii():
            return self.split(text)
        ends = list(accumulate(map(len, self.split(text.translate(self.classes)))))
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token; those not in the cache are encoded by the library's model, in its letters for bytes."""
        try:
            return list(map(self.cache.__getitem__, words))
        except KeyError:
            new = [w for w in set(words) if w not in self.cache]
        if len(self.cache) + len(new) > self.most:
            self.cache.clear()
            new = list(set(words))
        for w in new:
            self.cache[w] = len(self.tokenize(w.encode("utf-8").decode("latin-1").translate(self.letters)))
        out = list(map(self.cache.__getitem__, words))
        for w in new:
            if len(w) > self.longest:
                del self.cache[w]
        return out

    def read(self, text: str) -> tuple[list[int], list[int]]:
        """Lengths of the pre-tokens and special tokens of ``text`` in order, and their numbers of tokens."""
        if not self.plain:
            return self._by_library(text)
        lengths, numbers = [], []
        for k, part in enumerate(self.special.split(text)):
            words = [part] if k % 2 else self.words(part)
            lengths += map(len, words)
            numbers += [1] if k % 2 else self.counts(words)
        return lengths, numbers

    def _by_library(self, text: str) -> tuple[list[int], list[int]]:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        words = e.word_ids
        first = [k for k in range(len(words)) if not k or words[k] is None or words[k] != words[k - 1]]
        starts = [0, *[e.offsets[k][0] for k in first[1:]], len(text)]
        return [b - a for a, b in zip(starts, starts[1:])], [b - a for a, b in zip(first, [*first[1:], len(words)])]


class Resynchroniser:
    """Counts the tokens of texts chunk by chunk; ``splices`` and ``widenings`` say how often each was done."""

    def __init__(self, encoder: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.encoder, self.chunk, self.overlap = encoder, chunk, max(overlap, encoder.margin + 1)
        self.splices = self.widenings = 0

    def _read(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``text`` where the pre-tokens of a chunk begin, and all tokens before each of them and in all."""
        lengths, numbers = self.encoder.read(text[start:end])
        return start + np.cumsum([0, *lengths[:-1]]), np.cumsum([0, *numbers])

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return sum(self.encoder.read(text)[1])
        start, end, proven, total, width = 0, self.chunk, 0, 0, self.overlap
        at, before = self._read(text, start, end)
        while end < len(text):
            if end - width <= start:
                end = min(len(text), 2 * end - start)
                at, before = self._read(text, start, end)
                width = self.overlap
                continue
            last = min(len(text), end + self.chunk)
            more, more_before = self._read(text, end - width, last)
            common = np.intersect1d(at, more, assume_unique=True)
            common = common[(common >= proven) & (common <= end - self.encoder.margin)]
            if not len(common):
                width *= 2
                self.widenings += 1
                continue
            cut = int(common[-1])
            total += int(before[np.searchsorted(at, cut)] - before[np.searchsorted(at, proven)])
            self.splices += 1
            start, end, proven, width, at, before = end - width, last, cut, self.overlap, more, more_before
        return total + int(before[-1] - before[np.searchsorted(at, proven)])


def _count(path: str, chunk: int, overlap: int):
    def run(batches):
        counter = Resynchroniser(Encoder(path), chunk, overlap)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(map(counter.count, texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``documents``.

    ``tokenizer`` is the path of a BPE file of the tokenizers library, the same on all machines. Neighbouring chunks of
    ``chunk`` characters overlap by ``overlap``; the result doesn't depend on either.
    """
    bounded_batches(documents.sparkSession)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = rows.mapInArrow(_count(tokenizer, chunk, overlap), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
