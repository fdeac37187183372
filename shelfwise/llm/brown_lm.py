"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end of text. What is
clustered are *items*: each of the ``core`` most frequent words, the end, and for all other words
(seen or not) one item per hash of their last three bytes. So every word has a class, and the
class map has a fixed size whatever the vocabulary.

1. Word counts of all training tokens (one shuffle of pre-counted words).
2. Neighbour counts of every item, packed in one row per item. A map task sends at most two rows an
   item, so a frequent word does not gather its occurrences anywhere.
3. Exchange: per round one pass sums the class-to-class counts and one pass moves items (half of
   them each round, so that neighbours do not swap past each other) to the class with the largest
   gain in the class bigram likelihood. Both passes run over the rows of 2, on Spark; the driver
   holds classes x classes counts and one class per item.
4. P(word | previous) = P(class | previous class) * P(word | class), both smoothed. Each class has
   one unseen word, so the probabilities add up to one.

Counts of the ``head`` most frequent words are looked up in the scoring pass; all other tokens
are joined with the whole vocabulary, so no count is cut off. Words are told apart by 64-bit hashes.

Null texts are empty (one token, the end); null ids count as training rows; each row is scored by
itself, also if ids or texts repeat. No training rows: every word is unseen. Extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_arrow, stored, words_of

#: Words a worker remembers; a memory bound only (emptied when full).
REMEMBERED = 300_000
PAIRS_HELD = 2_000_000


@dataclass(frozen=True)
class Shape:
    """Fixed sizes of the model: core words, endings, classes, head words, exchange rounds."""
    core: int = 4096
    endings: int = 1024
    classes: int = 64
    head: int = 65536
    rounds: int = 6
    pull: float = 50.0

    @property
    def items(self) -> int:
        return self.core + self.endings + 1

    @property
    def end(self) -> int:
        return self.core + self.endings


@dataclass(frozen=True)
class Model:
    """``vocabulary`` (h, n, ending) is a table; the arrays have fixed sizes (see Shape)."""
    shape: Shape
    vocabulary: DataFrame
    head_hash: np.ndarray
    head_count: np.ndarray
    item_class: np.ndarray
    log_step: np.ndarray
    log_class: np.ndarray
    tokens: int
    types: int
    ends: int


def _hash(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest
    h = xxh3_64_intdigest(word)
    return h - (1 << 64) if h >= 1 << 63 else h


class Words:
    """Word properties of a worker: hash, item, count among the head words (0: not there)."""

    def __init__(self, shape: Shape, head_hash: np.ndarray, head_count: np.ndarray):
        self.shape, self.index = shape, {}
        self.rank, self.counts = {h: k for k, h in enumerate(head_hash.tolist())}, head_count
        self.hash = np.zeros(REMEMBERED + 1, np.int64)
        self.item = np.zeros(REMEMBERED + 1, np.int32)
        self.count = np.zeros(REMEMBERED + 1, np.int64)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Rows of the words in the property arrays, valid until the next call."""
        index = self.index
        if len(index) + len(words) > REMEMBERED:
            index.clear()
            if len(words) > REMEMBERED // 2:  # a very long text: room for its own words
                n = max(REMEMBERED, len(words)) + 1
                self.hash, self.item, self.count = np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(n, np.int64)
        out = list(map(index.get, words))
        if None in out:
            self._add(list(dict.fromkeys(w for w, k in zip(words, out, strict=True) if k is None)))
            out = list(map(index.__getitem__, words))
        return np.array(out, np.int64)

    def _add(self, new: list[bytes]) -> None:
        """Properties of words not seen before, all at once."""
        from xxhash import xxh3_64_intdigest
        at = slice(len(self.index), len(self.index) + len(new))
        self.index.update(zip(new, range(at.start, at.stop), strict=True))
        self.hash[at] = np.array([xxh3_64_intdigest(w) for w in new], np.uint64).view(np.int64)
        rank = np.array([self.rank.get(h, -1) for h in self.hash[at].tolist()], np.int64)
        self.count[at] = np.where(rank >= 0, self.counts[rank], 0) if len(self.counts) else 0
        core, endings = self.shape.core, self.shape.endings
        self.item[at] = [r if 0 <= r < core else core + zlib.crc32(w[-3:]) % endings for r, w in zip(rank.tolist(), new, strict=True)]


def _ending(w: bytes, shape: Shape) -> int:
    return zlib.crc32(w[-3:]) % shape.endings


def _texts(b: pa.RecordBatch, column: int = 0) -> Iterator[list[bytes]]:
    for x in b.column(column):
        yield words_of(x.as_py(), lower=True)


# ---- counts ---------------------------------------------------------------------------------

def vocabulary(texts: DataFrame, shape: Shape) -> DataFrame:
    """(h, n, ending) of every word of the one-column table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([_hash(w) for w in held], pa.int64()), pa.array(list(held.values()), pa.int64()),
                                               pa.array([_ending(w, shape) for w in held], pa.int32())], names=["h", "n", "ending"])
        for b in batches:
            for words in _texts(b):
                held.update(words)
                if len(held) > REMEMBERED:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return map_arrow(texts, run, "h long, n long, ending int").groupBy("h").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


def contexts(texts: DataFrame, words: tuple[np.ndarray, np.ndarray], shape: Shape) -> DataFrame:
    """(item, right, left): packed counts, by item, of what follows and precedes every item."""
    shared = texts.sparkSession.sparkContext.broadcast(words)  # head words: a fixed number of hashes and counts
    items = shape.items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts, held = Words(shape, *shared.value), [], 0
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def fold():
            c, n = np.unique(np.concatenate(parts), return_counts=True)
            all_c, where = np.unique(np.concatenate([codes, c]), return_inverse=True)
            return all_c, np.bincount(where, np.concatenate([counts, n])).astype(np.int64)

        def out():
            for side, (a, b) in enumerate((np.divmod(codes, items), np.divmod(codes, items)[::-1])):
                order = np.argsort(a, kind="stable")
                a, b, n = a[order], b[order].astype(np.int32), counts[order]
                cut = np.flatnonzero(np.diff(a)) + 1
                first = np.r_[0, cut] if len(a) else cut
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[first], pa.int32()), pa.array(np.full(len(first), side), pa.int32()),
                     pa.array([x.tobytes() for x in np.split(b, cut)] if len(a) else [], pa.binary()),
                     pa.array([x.astype(np.int64).tobytes() for x in np.split(n, cut)] if len(a) else [], pa.binary())],
                    names=["item", "side", "other", "n"])
        for b in batches:
            for words_ in _texts(b):
                x = np.full(len(words_) + 2, shape.end, np.int64)
                x[1:-1] = table.item[table.places(words_)]
                parts.append(x[:-1] * items + x[1:])
                held += len(x)
                if held > PAIRS_HELD:
                    codes, counts = fold()
                    parts, held = [], 0
                    if len(codes) > PAIRS_HELD:
                        yield from out()
                        codes, counts = codes[:0], counts[:0]
        if parts:
            codes, counts = fold()
        if len(codes):
            yield from out()

    sent = map_arrow(texts, run, "item int, side int, other binary, n binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def row():
            packed = []
            for s in sums:
                k = np.flatnonzero(s)
                packed += [k.astype(np.int32).tobytes(), s[k].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)],
                                              names=["item", "right", "right_n", "left", "left_n"])
        for b in batches:
            for item, side, other, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if item != now:
                    if now is not None:
                        yield row()
                    now, sums = item, [np.zeros(items, np.int64), np.zeros(items, np.int64)]
                sums[side][np.frombuffer(other, np.int32)] += np.frombuffer(n, np.int64)
        if now is not None:
            yield row()

    return map_arrow(sent.repartition("item").sortWithinPartitions("item"), merge,
                     "item int, right binary, right_n binary, left binary, left_n binary")


# ---- exchange -------------------------------------------------------------------------------

def _by_class(other: bytes, n: bytes, classes: np.ndarray, size: int, skip: int = -1) -> tuple[np.ndarray, int]:
    k, c = np.frombuffer(other, np.int32), np.frombuffer(n, np.int64)
    own = int(c[k == skip].sum())
    keep = k != skip
    return np.bincount(classes[k[keep]], c[keep], size), own


def class_counts(ctx: DataFrame, classes: np.ndarray, shape: Shape) -> np.ndarray:
    size = shape.classes
    shared = ctx.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            for item, right, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total[shared.value[item]] += _by_class(right, n, shared.value, size)[0]
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total.ravel()[k].astype(np.int64))], names=["cell", "n"])

    out = np.zeros(size * size)
    for r in map_arrow(ctx.select("item", "right", "right_n"), run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # classes**2 rows at most
        out[r[0]] = r[1]
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def best_class(m: np.ndarray, a: int, right: np.ndarray, left: np.ndarray, own: int) -> int:
    """The class of largest likelihood for one item, now in class ``a``: its counts are taken out of
    the class bigrams, and for each class the gain of putting them in is computed."""
    rest = m.copy()
    rest[a, :] -= right
    rest[:, a] -= left
    rest[a, a] -= own
    size, base = right.sum() + own, _xlogx(rest)
    d = np.arange(len(m))
    rows = _xlogx(rest + right[None, :]) - base
    cols = _xlogx(rest + left[:, None]) - base
    diag = _xlogx(rest[d, d] + right + left + own) - base[d, d]
    n = m.sum(axis=1)  # tokens by class
    n[a] -= size
    gain = rows.sum(axis=1) - rows[d, d] + cols.sum(axis=0) - cols[d, d] + diag - 2 * (_xlogx(n + size) - _xlogx(n))
    gain = gain[:-1]  # the last class is the end's own
    best = int(gain.argmax())
    return best if gain[best] > gain[a] + 1e-9 else a


def exchange(ctx: DataFrame, shape: Shape) -> np.ndarray:
    """Class of every item."""
    size = shape.classes
    classes = (np.arange(shape.items) % (size - 1)).astype(np.int32)
    classes[shape.end] = size - 1
    sc = ctx.sparkSession.sparkContext
    for k in range(shape.rounds):
        shared = sc.broadcast((class_counts(ctx, classes, shape), classes))

        def run(batches: Iterator[pa.RecordBatch], k=k, shared=shared) -> Iterator[pa.RecordBatch]:
            m, now = shared.value
            for b in batches:
                item, to = [], []
                for i, right, rn, left, ln in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if i != shape.end and zlib.crc32(b"%d" % i) % 2 == k % 2:
                        r, own = _by_class(right, rn, now, size, i)
                        best = best_class(m, int(now[i]), r, _by_class(left, ln, now, size, i)[0], own)
                        if best != now[i]:
                            item.append(i)
                            to.append(best)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(to, pa.int32())], names=["item", "to"])

        moved = map_arrow(ctx, run, "item int, to int").collect()  # at most shape.items rows
        for r in moved:
            classes[r["item"]] = r["to"]
        if not moved and k:
            break
    return classes


# ---- model ----------------------------------------------------------------------------------

def in_training(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 5 != 1


def _frequent(words: DataFrame, k: int) -> DataFrame:
    """Words that hold the ``k`` most frequent: those of counts at least as large as the k-th needs, by
    counts of words by the size of their count (a few hundred classes)."""
    size = F.floor(8 * F.log2("n"))
    at, cut = 0, 0
    for r in sorted(words.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        at, cut = at + r["k"], r["size"]
        if at >= k:
            break
    return words.where(size >= cut)


def fit(texts: DataFrame, text_col: str = "text", shape: Shape = Shape()) -> Model:
    """Learns from every row of ``texts``."""
    texts = texts.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    words = stored(vocabulary(texts, shape), "vocabulary")
    n_words, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = texts.count()
    top = stored(_frequent(words, shape.head).orderBy(F.desc("n"), "h").limit(shape.head), "head-words").collect()  # a fixed number of words
    top.sort(key=lambda r: (-r["n"], r["h"]))
    head_hash = np.array([r["h"] for r in top], np.int64)
    head_count = np.array([r["n"] for r in top], np.int64)
    ctx = stored(contexts(texts, (head_hash, head_count), shape), "contexts")
    classes = exchange(ctx, shape)
    m = class_counts(ctx, classes, shape)
    size = shape.classes
    in_class = m.sum(axis=0)  # tokens by class
    kinds = np.zeros(shape.items)
    kinds[:min(len(top), shape.core)] = 1
    for r in words.groupBy("ending").count().collect():  # shape.endings rows at most
        kinds[shape.core + r["ending"]] = r["count"]
    for r in top[:shape.core]:
        kinds[shape.core + r["ending"]] -= 1
    kinds[shape.end] = 1 if ends else 0
    types_of = np.bincount(classes, kinds, size)
    one = (in_class + 0.5) / (in_class.sum() + 0.5 * size)
    step = (m + shape.pull * one[None, :]) / (m.sum(axis=1, keepdims=True) + shape.pull)
    return Model(shape, words, head_hash, head_count, classes, np.log10(step), np.log10(in_class + 0.5 * (types_of + 1)),
                 int(n_words) + ends, int(types) + (1 if ends else 0), ends)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    shape = model.shape
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.head_hash, model.head_count, model.item_class, model.log_step, model.log_class))
    ends = model.ends
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_hash, head_count, item_class, log_step, log_class = shared.value
        table = Words(shape, head_hash, head_count)
        names = ["row", "id", "n_tokens", "n_known", "log_counts", "log_classes", "h", "k"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        end_log = float(np.log10(ends + 0.5))
        for b in batches:
            own, far = [], []
            for row, i, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _texts(b, 2), strict=True):
                at = table.places(words)
                c = np.full(len(words) + 2, shape.classes - 1, np.int64)
                c[1:-1] = item_class[table.item[at]]
                n = table.count[at]
                here = n > 0
                own.append((row, i, len(words) + 1, int(here.sum()) + (ends > 0), float(np.log10(n[here] + 0.5).sum()) + end_log,
                            float(log_step[c[:-1], c[1:]].sum() - log_class[c[1:]].sum()), None, None))
                if not here.all():
                    h, k = np.unique(table.hash[at[~here]], return_counts=True)
                    far.append((np.full(len(h), row), h, k))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*own, strict=True), kinds, strict=True)] if own else
                                             [pa.array([], t) for t in kinds], names=names)
            if far:
                row, h, k = (np.concatenate(x) for x in zip(*far, strict=True))
                none = [pa.nulls(len(row), t) for t in kinds[1:6]]
                yield pa.RecordBatch.from_arrays([pa.array(row), *none, pa.array(h), pa.array(k)], names=names)

    found = stored(map_arrow(rows, run, "row long, id long, n_tokens long, n_known long, log_counts double, log_classes double, h long, k long"), "scored")
    far = (found.where("h is not null").select("row", "h", "k").join(model.vocabulary.select("h", "n"), "h", "left").groupBy("row")
           .agg(F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("known"),
                F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("logs")))
    log_all = float(np.log10(model.tokens + 0.5 * (model.types + 1)))
    logs = F.col("log_counts") + F.coalesce("logs", F.lit(0.0))
    return found.where("h is null").drop("h", "k").join(far, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * log_all).alias("base_score"),
        (logs + F.col("log_classes")).alias("score"))
