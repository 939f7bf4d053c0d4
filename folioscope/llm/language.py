"""Language identification by interpolated Kneser-Ney models of characters.

Texts become lower-case letters, every run of other characters one blank, with a blank at both ends. Learning counts the
ORDER-grams of all labelled texts per language, aggregated in each task before a shuffle. From these, per language, follow
the Kneser-Ney probabilities of all orders: absolute counts at the highest, numbers of distinct predecessors below,
interpolated down to the uniform distribution. They are stored as sorted arrays of 64-bit hashes with a column of
log-probabilities per language.

No gram is left out. Up to ``most`` cells, distinct grams times languages, the model is broadcast, with a probability for every cell. Beyond
that it stays a table in Spark: for every order the own probability of each gram and the back-off weight of each context, in those languages only
that have it. Texts are then scored in chunks (lookups.py): the distinct grams, suffixes and contexts of a chunk are
joined with the table, and a task computes probabilities from its chunk's share. So nothing of the model passes through the driver, a
rare gram costs one language's entry, texts aren't shuffled, and the number of passes is the same for any model.

A text gets the language of the lowest cross-entropy per character. Its score is the posterior of that language,
with the text's length counted up to CONFIDENT characters. Rejection is calibrated: a text is rejected if its cross-entropy
exceeds its language's mean by more than SLACK bits plus q / sqrt(length), where q is the QUANTILE of that
excess (its rank within 1 / RANKS) over all distinct learned texts. Every language of the model has learned texts, and so a mean.

A text that is null or has no letters is ``und``, with score 0, and rejected. Ties go to the language that
sorts first. Without any labelled text every prediction is ``und``. Rows are independent in prediction; repeated rows count as
often as they occur in learning; other columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from folioscope.llm import lookups
from folioscope.llm.carried import parted
from folioscope.llm.words import mix
from folioscope.storage import bounded_batches, frugal, land, release

ORDER, MOST, SLACK, QUANTILE, RANKS, CONFIDENT, FLUSH = 4, 1_600_000, 1.0, 0.999, 100_000, 50, 4_000_000
#: Distinct grams of the texts that a task scores at once, where the model isn't broadcast.
CHUNK = 200_000
UND = "und"
_LETTER: list[np.ndarray] = []


def characters(text: str | None) -> np.ndarray:
    """Code points of a text's normal form; empty if it has no letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    x = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTER[0][x]
    if not letter.any():
        return np.empty(0, np.uint64)
    x = np.concatenate([[32], np.where(letter, x, 32), [32]]).astype(np.uint64)
    return x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]


def gram_keys(x: np.ndarray) -> np.ndarray:
    """ORDER characters in 16 bits each (code points beyond are folded); the last is the predicted one."""
    x = (x ^ (x >> np.uint64(16))) & np.uint64(0xFFFF)
    out = np.zeros(max(0, len(x) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | x[i : i + len(out)]
    return out


def padded(x: np.ndarray) -> np.ndarray:
    """Blanks before a text's first character, so that each of its characters ends a gram."""
    return np.concatenate([np.full(ORDER - 2, 32, np.uint64), x]) if len(x) else x


def _counted(batches):
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            for k in range(0, len(keys), 100_000):
                part = keys[k : k + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(n[k : k + 100_000], pa.int64())], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys = gram_keys(padded(characters(text)))
            held.setdefault(lang, []).append(keys)
            size += len(keys)
            if size >= FLUSH:
                yield from flush()
                size = 0
    yield from flush()


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of values of each."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, values, len(found))


def discount_of(n1: int, n2: int) -> float:
    """Of absolute discounting, from the numbers of grams counted once and twice."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


class Model:
    """Kneser-Ney models of several languages; ``counts`` has (grams, counts) and the discount of each."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray, float]]):
        self.langs = sorted(counts)
        symbols = set()
        for keys, _, _ in counts.values():
            symbols.update(np.unique(keys & np.uint64(0xFFFF)).tolist())
        self.uniform = 1 / (len(symbols) + 1)
        #: For n characters, n from 1 to ORDER: hashes of grams and log2-probabilities; for their n - 1 first: back-off weights.
        self.grams: list = [None] * (ORDER + 1)
        self.contexts: list = [None] * (ORDER + 1)
        raw: dict[int, list] = {n: [] for n in range(1, ORDER + 1)}
        for lang in self.langs:
            keys, n, discount = counts[lang]
            for order in range(ORDER, 0, -1):
                context, total = _sums(keys >> np.uint64(16), n.astype(float))
                _, kinds = _sums(keys >> np.uint64(16), np.ones(len(keys)))
                at = np.searchsorted(context, keys >> np.uint64(16))
                raw[order].append((keys, np.maximum(n - discount, 0) / total[at], context, np.minimum(1, discount * kinds / total)))
                mask = np.uint64((1 << 16 * (order - 1)) - 1)
                keys, n = _sums(keys & mask, np.ones(len(keys)))
                discount = discount_of((n == 1).sum(), (n == 2).sum())
        for order in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([r[0] for r in raw[order]] or [np.empty(0, np.uint64)]))
            contexts = np.unique(np.concatenate([r[2] for r in raw[order]] or [np.empty(0, np.uint64)]))
            own, weight = np.zeros((len(keys), len(self.langs))), np.ones((len(contexts), len(self.langs)))
            for i, (k, p, c, w) in enumerate(raw[order]):
                own[np.searchsorted(keys, k), i] = p
                weight[np.searchsorted(contexts, c), i] = w
            hashed = mix(contexts)
            by = np.argsort(hashed)
            self.contexts[order] = hashed[by], weight[by]
            p = own + self._weight(order, keys) * self._lower(order, keys)
            hashed = mix(keys)
            by = np.argsort(hashed)
            self.grams[order] = hashed[by], p[by]

    def _lower(self, order: int, keys: np.ndarray) -> np.ndarray:
        if order == 1:
            return np.full((len(keys), len(self.langs)), self.uniform)
        return self.probabilities(order - 1, keys & np.uint64((1 << 16 * (order - 1)) - 1))

    def _weight(self, order: int, keys: np.ndarray) -> np.ndarray:
        hashed, weight = self.contexts[order]
        out = np.ones((len(keys), len(self.langs)))
        at, found = _look(hashed, mix(keys >> np.uint64(16)))
        out[found] = weight[at[found]]
        return out

    def probabilities(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Per gram of ``order`` characters and language."""
        hashed, p = self.grams[order]
        out = np.empty((len(keys), len(self.langs)))
        at, found = _look(hashed, mix(keys))
        out[found] = p[at[found]]
        rest = keys[~found]
        if len(rest):
            out[~found] = self._weight(order, rest) * self._lower(order, rest)
        return out

    def bits(self, x: np.ndarray) -> np.ndarray:
        """Bits of a text's normal form, for each language."""
        keys, n = np.unique(gram_keys(padded(x)), return_counts=True)
        return -(n @ np.log2(self.probabilities(ORDER, keys)))


def _look(hashed: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashed):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(hashed, keys), len(hashed) - 1)
    return at, hashed[at] == keys


def _tagged(kind: int, order: int, keys: np.ndarray) -> np.ndarray:
    """Keys of the table: grams of ORDER characters as they are, all others with a mark above them, from the code points U+FDD0 to
    U+FDD7, which aren't characters: grams (kind 0) of 1 to 3 characters, and contexts (kind 1) of 0 to 3."""
    return keys if (kind, order) == (0, ORDER) else keys | np.uint64((0xFDD0 + order - 1 + kind * (ORDER - 1)) << 48)


def needed(text: str | None) -> set[int]:
    """Keys of everything that scoring a text may read, as signed integers."""
    keys = np.unique(gram_keys(padded(characters(text))))
    parts = []
    for order in range(ORDER, 0, -1):
        keys = np.unique(keys & np.uint64((1 << 16 * order) - 1)) if order < ORDER else keys
        parts += [_tagged(0, order, keys), _tagged(1, order, np.unique(keys >> np.uint64(16)))]
    return set(np.concatenate(parts).view(np.int64).tolist())


class Share:
    """What a chunk needs of the table: (key, langs, values) of its grams and contexts."""

    def __init__(self, entries: pa.Table | None, n_langs: int, uniform: float):
        self.n_langs, self.uniform = n_langs, uniform
        keys = np.empty(0, np.uint64) if entries is None else entries["key"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        langs, values = ([] if entries is None else entries[c].combine_chunks().take(pa.array(order)) for c in ("langs", "values"))
        self.starts = np.concatenate([[0], np.cumsum(langs.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64) if len(langs) else np.zeros(1, np.int64)
        self.langs, self.values = (x.flatten().to_numpy(zero_copy_only=False) if len(x) else np.empty(0) for x in (langs, values))

    def fill(self, out: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Sets what the table has of ``keys`` in a matrix by key and language."""
        at, known = _look(self.keys, keys)
        at, rows = at[known], np.flatnonzero(known)
        n = self.starts[at + 1] - self.starts[at] if len(at) else np.empty(0, np.int64)
        place = np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[np.repeat(rows, n), self.langs[place].astype(np.int64)] = self.values[place]
        return out

    def bits(self, x: np.ndarray) -> np.ndarray:
        """Bits of a text's normal form, for each language."""
        keys, n = np.unique(gram_keys(padded(x)), return_counts=True)
        p = np.full((len(keys), self.n_langs), self.uniform)
        for order in range(1, ORDER + 1):
            own = keys & np.uint64((1 << 16 * order) - 1)
            weight = self.fill(np.ones(p.shape), _tagged(1, order, own >> np.uint64(16)))
            p = self.fill(np.zeros(p.shape), _tagged(0, order, own)) + weight * p
        return -(n @ np.log2(p))


class Identifier:
    """A model, broadcast or as a table of (key, langs, values), and the calibration of rejection."""

    def __init__(self, langs: list[str], model: Broadcast | None = None, entries: DataFrame | None = None, uniform: float = 1.0, chunk: int = CHUNK):
        self.langs, self.block, self.entries, self.uniform, self.chunk = langs, model, entries, uniform, chunk
        self.means, self.q = {}, 0.0

    @property
    def model(self) -> Model | None:
        """The model, if it is broadcast."""
        return self.block.value if self.block else None

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, cross-entropy and whether it is rejected, of one text on the driver."""
        x = characters(text)
        if not len(x) or not self.langs:
            return decide(self.langs, self.means, self.q, x, None)
        model = self.model or Share(self.entries.where(F.col("key").isin(list(needed(text)))).toArrow(), len(self.langs), self.uniform)
        return decide(self.langs, self.means, self.q, x, model.bits(x))


def decide(langs: list[str], means: dict[str, float], q: float, x: np.ndarray, bits: np.ndarray | None) -> tuple[str, float, float | None, bool]:
    """What ``predict`` says of a normal form with ``bits`` in each language."""
    if not len(x) or not langs:
        return UND, 0.0, None, True
    h = bits / (len(x) - 1)
    best = int(np.argmin(h))
    lang, least = langs[best], float(h[best])
    score = 1 / float(np.exp2((least - h) * min(len(x), CONFIDENT)).sum())
    return lang, score, least, least - means[lang] > SLACK + q / len(x) ** 0.5


def _pass(of_batch, finish, added: pa.Schema, keep: bool, carried: int):
    """Replaces the first column, the text, unless ``keep``, and the last ``carried`` ones by what ``finish`` makes of a text's normal form and
    bits; ``of_batch`` gives each row's model."""

    def run(batches):
        for batch in batches:
            out = []
            for text, model in zip(batch.column(0).to_pylist(), of_batch(batch)):
                x = characters(text)
                out.append(finish(x, model.bits(x) if model and len(x) else None))
            columns = list(zip(*out)) if out else [[]] * len(added)
            kept = slice(0 if keep else 1, len(batch.columns) - carried)
            yield pa.RecordBatch.from_arrays([*batch.columns[kept], *[pa.array(c, f.type) for c, f in zip(columns, added)]], [*batch.schema.names[kept], *added.names])

    return run


def _scored(rows: DataFrame, known: Identifier, finish, added: pa.Schema, keep: bool = False) -> DataFrame:
    """``rows``, without their first column, the text, unless ``keep``, and with the columns that ``finish`` makes of its normal form and bits."""
    schema = T.StructType([*rows.schema.fields[0 if keep else 1 :], *from_arrow_schema(added).fields])
    if known.entries is None:
        block = known.block
        return rows.mapInArrow(frugal(_pass(lambda batch: [block.value if block else None] * len(batch), finish, added, keep, 0)), schema)
    chunks = lookups.chunked(rows, needed, known.chunk)
    folder = lookups.found(chunks, needed, "key", known.entries)
    n, uniform = len(known.langs), known.uniform

    def run(batches):
        share = lookups.by_chunk(folder, lambda entries: Share(entries, n, uniform))
        yield from _pass(lambda batch: (share(p, c) for p, c in zip(batch.column(len(batch.columns) - 2).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist())), finish, added, keep, 2)(batches)

    return chunks.mapInArrow(frugal(run), schema)


def _calibration(rows: DataFrame, known: Identifier) -> tuple[dict[str, float], float]:
    """Each language's mean cross-entropy, and the quantile of the excess, over all distinct texts with letters.

    Texts are scored where they lie; only their hashes and numbers are shuffled, after partial aggregates.
    """
    added = pa.schema([("all_bits", pa.list_(pa.float64())), ("length", pa.int64())])
    hashed = rows.select("text", "lang", F.xxhash64("text", "lang").alias("h"))
    scored = _scored(hashed, known, lambda x, bits: (None if bits is None else bits.tolist(), len(x)), added).where("length > 0")
    own = F.get("all_bits", F.array_position(F.array(*map(F.lit, known.langs)), F.col("lang")).cast("int") - 1)
    scored = scored.select("h", "lang", (own / (F.col("length") - 1)).alias("bits"), "length")
    texts = land(scored.groupBy("h", "lang").agg(F.max("bits").alias("bits"), F.max("length").alias("length")), "calibration")
    # as decimals, so that the order of tasks doesn't change the sums
    total = F.sum((F.col("bits") * F.col("length")).cast("decimal(28,9)")).cast("double")
    means = {r.lang: r["mean"] for r in texts.groupBy("lang").agg((total / F.sum("length")).alias("mean")).collect()}
    mean = F.element_at(F.create_map(*[F.lit(x) for pair in means.items() for x in pair]), F.col("lang"))
    excess = (F.col("bits") - mean) * F.sqrt(F.col("length"))
    return means, max(0.0, texts.agg(F.percentile_approx(excess, QUANTILE, RANKS)).first()[0])


def _arrays(table: pa.Table, langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of each language."""
    of, grams, n = table["lang"].to_numpy(), table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
    return {k: (grams[at], n[at]) for k in langs for at in [of == k]}


def _entries(counts: DataFrame, langs: list[str]) -> tuple[DataFrame, float]:
    """The model as a landed table of (key, langs, values), and the uniform probability. Counts of all orders are made in Spark."""
    place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1
    table, now, symbols = None, counts, 1
    for order in range(ORDER, 0, -1):
        discounts, _ = _discounts(now)
        discount = F.element_at(F.create_map(*[F.lit(x) for pair in discounts.items() for x in pair]), F.col("lang"))
        contexts = now.groupBy("lang", F.shiftrightunsigned("gram", 16).alias("context")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        contexts = land(contexts, f"contexts{order}")
        mark = lambda kind: F.lit(int(_tagged(kind, order, np.zeros(1, np.uint64)).view(np.int64)[0]))  # noqa: B023, E731
        own = now.withColumn("context", F.shiftrightunsigned("gram", 16)).join(contexts, ["lang", "context"])
        own = own.select(F.col("gram").bitwiseOR(mark(0)).alias("key"), place.alias("i"), (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("v"))
        weights = contexts.select(F.col("context").bitwiseOR(mark(1)).alias("key"), place.alias("i"), F.least(F.lit(1.0), discount * F.col("kinds") / F.col("total")).alias("v"))
        both = own.unionByName(weights)
        table = both if table is None else table.unionByName(both)
        if order > 1:
            now = land(now.groupBy("lang", F.col("gram").bitwiseAND((1 << 16 * (order - 1)) - 1).alias("gram")).agg(F.count("*").alias("n")), f"grams{order - 1}")
        else:
            symbols = now.select("gram").distinct().count()
    # a key has one entry per language at most
    table = table.groupBy("key").agg(F.collect_list(F.struct("i", "v")).alias("x")).select("key", F.col("x.i").alias("langs"), F.col("x.v").alias("values"))
    return land(table, "model"), 1 / (symbols + 1)


def _discounts(counts: DataFrame) -> tuple[dict[str, float], int]:
    """By language, and the number of all grams."""
    found = counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count("*").alias("size")).collect()
    return {r.lang: discount_of(r.n1, r.n2) for r in found}, sum(r["size"] for r in found)


def learn(labelled: DataFrame, most: int = MOST, chunk: int = CHUNK) -> Identifier:
    """Learns from rows of (lang, text), lang not null."""
    spark = labelled.sparkSession
    bounded_batches(spark)
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = land(rows.select("lang", "text").mapInArrow(frugal(_counted), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    discounts, total = _discounts(counts)
    langs = sorted(discounts)
    if not langs:
        return Identifier([])
    cells = total * len(langs)
    if cells > most:
        cells = counts.select("gram").distinct().count() * len(langs)
    if cells <= most:
        arrays = _arrays(counts.toArrow(), langs)
        out = Identifier(langs, spark.sparkContext.broadcast(Model({k: (*v, discounts[k]) for k, v in arrays.items()})))
        release(counts)
    else:
        out = Identifier(langs, None, *_entries(counts, langs), chunk)
    out.means, out.q = _calibration(rows, out)
    return out


def held_out() -> Column:
    """Whether a row of documents takes no part in learning; null doc_ids do."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame, identifier: Identifier) -> DataFrame:
    """For every row of ``documents``: ``row``, its columns, lang_pred, score, bits and rejected, from the text alone."""
    bounded_batches(documents.sparkSession)
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("rejected", pa.bool_())])
    rows, row = parted(documents)
    scored = _scored(rows, identifier, partial(decide, identifier.langs, identifier.means, identifier.q), added, keep=True)
    return scored.select(row.alias("row"), *added.names)
