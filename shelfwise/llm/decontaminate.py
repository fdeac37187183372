"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

Words are lower-cased and cut at white space and ASCII punctuation. Training passages are aligned
with the item (match 2, mismatch -1, gap -1); the similarity is the score over the item's best
possible one. Pairs of at least ``similar`` are reported with the aligned stretch of the document.

Seeds lose no pair. An alignment of M matches and E errors with an item of m words is reported if
2M - E >= 2 * similar * m. Two matches in a row that lie more than two words apart, in the item or
in the document, cost two errors at least, so at least M - 1 - E / 2 >= similar * m - 1 matches have
their next one or two words on, on both sides. And the alignment takes up at most
M + E <= (3 - 2 * similar) * m words (a *span*). So of an item's words, that many (``need``) must start
such a pair found inside two neighbouring spans of a document. Of the W words of an item that start
pairs, any W - need + 1 then hold one that is found: those whose pairs are rarest in the benchmark are
the item's seeds. Only stretches in which a seed is found have their other pairs counted, and only
those with ``need`` words found are aligned.

Scale: the benchmark is sent to the tasks in parts of about ``PART_CHARS`` characters, one pass over
the documents each (a single one for any usual benchmark). A pass reads every text where it lies and
shuffles only the reported pairs. An item that a third of all documents hold costs its alignments
in each of them.

Nulls: null texts have no words; null ids are reported as null. Items shorter than ``gram`` words
are not searched for (nothing tells them from chance). Repeated rows with equal id and text count
as one. Ties between stretches: the first. Empty tables: no pairs. Extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import _MUL, hash_words, in_bitmap, map_arrow, mix64, stored

MATCH, MISMATCH, GAP = 2, -1, 1
BATCH = 256
#: Cells of a row of a batch's alignment tables, hits looked at at once, benchmark characters a pass: memory bounds only.
CELLS = 1 << 18
HITS = 1 << 20
PART_CHARS = 1 << 24
#: ASCII punctuation becomes white space.
_PLAIN = bytes(32 if chr(i) in string.punctuation else i for i in range(256))


@dataclass(frozen=True)
class Search:
    gram: int = 3
    similar: float = 0.5
    log2_bits: int = 23


def plain_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


# ---- alignment ------------------------------------------------------------------------------

def smith_waterman(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best score, its last item word, its last passage word) of each pair, for a batch at once.
    A row of the table is a running maximum, so gaps along the passage need no inner loop."""
    n, m, w = len(items), max(map(len, items)), max(map(len, passages))
    a = np.zeros((n, m), np.uint64)
    b = np.zeros((n, w), np.uint64)
    in_a, in_b = np.zeros((n, m), bool), np.zeros((n, w), bool)
    for k, (x, y) in enumerate(zip(items, passages, strict=True)):
        a[k, :len(x)], b[k, :len(y)] = x, y
        in_a[k, :len(x)], in_b[k, :len(y)] = True, True
    slope = GAP * np.arange(w + 1, dtype=np.int32)
    before = np.zeros((n, w + 1), np.int32)
    best, at_item, at_word = np.zeros(n, np.int32), np.full(n, -1), np.full(n, -1)
    who = np.arange(n)
    for i in range(m):
        same = (a[:, i, None] == b) & in_a[:, i, None] & in_b
        now = np.zeros((n, w + 1), np.int32)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where(same, MATCH, MISMATCH), before[:, 1:] - GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        j = now.argmax(axis=1)
        s = now[who, j]
        up = s > best
        best[up], at_item[up], at_word[up] = s[up], i, j[up] - 1
        before = now
    return best, at_item, at_word


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(score, first word, past last word) in the passage; the start is the end of the alignment of
    the reversed words up to the best end."""
    best, i, j = smith_waterman(items, passages)
    live = np.flatnonzero(best > 0)
    first = np.zeros(len(best), np.int64)
    if len(live):
        _, _, back = smith_waterman([items[k][:i[k] + 1][::-1] for k in live], [passages[k][:j[k] + 1][::-1] for k in live])
        first[live] = j[live] - back
    return [(int(s), int(f), int(e) + 1) for s, f, e in zip(best, first, j, strict=True)]


# ---- candidates -----------------------------------------------------------------------------

def word_pairs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first word) of all pairs of words that are one or two words apart."""
    x = mix64(h) * _MUL
    near, far = mix64(x[:-1] + h[1:]), mix64(x[:-2] + h[2:])
    return np.concatenate([near, far]), np.r_[np.arange(len(near)), np.arange(len(far))]


class Seeds:
    """The items of one part of the benchmark and where their word pairs are."""

    def __init__(self, items: list[np.ndarray], search: Search):
        self.items = items
        sizes = np.array([len(x) for x in items], np.int64)
        self.need = np.maximum(np.ceil(search.similar * sizes - 1 - 1e-9), 1).astype(np.int64)
        self.span = np.maximum(np.ceil((3 - 2 * search.similar) * sizes - 1e-9), 1).astype(np.int64)
        self.item = np.repeat(np.arange(len(items)), sizes)  # of every word of the part
        start = np.r_[0, np.cumsum(sizes)]
        found = [word_pairs(x) for x in items]
        pair = np.concatenate([f[0] for f in found])
        word = np.concatenate([f[1] + start[k] for k, f in enumerate(found)])
        order = np.argsort(pair, kind="stable")
        self.word = word[order]
        self.pair, self.first, self.count = np.unique(pair[order], return_index=True, return_counts=True)
        # seeds: the words of each item whose pairs are rarest, one more than may all be missing
        of_pair = np.repeat(np.arange(len(self.pair)), self.count)
        words = len(self.item)
        often = np.bincount(self.word, self.count[of_pair], words)
        order = np.lexsort((often, often == 0, self.item))  # words that start no pair come last
        place = np.empty(words, np.int64)
        place[order] = np.arange(words) - start[self.item]
        starts = np.bincount(self.item[often > 0], minlength=len(items))
        self.seed = (often > 0) & (place < (starts - self.need + 1)[self.item])
        self.rare = np.zeros(len(self.pair), bool)
        self.rare[of_pair[self.seed[self.word]]] = True
        self.bits = np.zeros(1 << search.log2_bits - 3, np.uint8)
        top = self.pair >> np.uint64(64 - search.log2_bits)
        np.bitwise_or.at(self.bits, (top >> np.uint64(3)).astype(np.int64), (1 << (top & np.uint64(7)).astype(np.int64)).astype(np.uint8))

    def _known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the pair, place) of those pairs of a document that the items have."""
        pair, at = word_pairs(h)
        hit = np.flatnonzero(in_bitmap(self.bits, pair))
        pair, at = pair[hit], at[hit]
        k = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        real = self.pair[k] == pair
        return k[real], at[real]

    def _hits(self, k: np.ndarray, at: np.ndarray) -> Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]]:
        """Parts of all (word of an item, place in the document) that start a shared pair; a bounded number
        at once, made anew for every pass if they are several."""
        n = self.count[k]
        parts = np.split(np.arange(len(k)), np.flatnonzero(np.diff(np.cumsum(n) // HITS)) + 1)

        def part(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            c = n[rows]
            return self.word[np.repeat(self.first[k[rows]], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)], np.repeat(at[rows], c)
        if len(parts) == 1:
            only = [part(parts[0])]
            return lambda: only
        return lambda: map(part, parts)

    def _tiles(self, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tile, word): a place counts for the tile it lies in and the one before."""
        tile = at // self.span[self.item[word]]
        before = tile > 0
        return np.concatenate([tile, tile[before] - 1]), np.concatenate([word, word[before]])

    def candidates(self, h: np.ndarray) -> list[tuple[int, int]]:
        """(item, first word): the item may be aligned within two spans of the document from there."""
        k, at = self._known(h)
        if not self.rare[k].any():
            return []
        items, words, hits = len(self.items), len(self.item), self._hits(k, at)
        # items that the whole document has too few pairs of are out of the question
        total = sum(np.bincount(self.item[word], minlength=items) for word, _ in hits())
        likely = (total >= self.need)[self.item]
        code = lambda t, w: t * items + self.item[w]
        seeded = [np.empty(0, np.int64)]
        for word, place in hits():
            live = (likely & self.seed)[word]
            seeded.append(np.unique(code(*self._tiles(word[live], place[live]))))
        seeded = np.unique(np.concatenate(seeded))
        if not len(seeded):
            return []
        found = []
        for word, place in hits():
            live = likely[word]
            tile, word = self._tiles(word[live], place[live])
            own = code(tile, word)
            live = seeded[np.minimum(np.searchsorted(seeded, own), len(seeded) - 1)] == own
            found.append(np.unique(tile[live] * words + word[live]))
        tile, word = np.divmod(np.unique(np.concatenate(found)), words)
        held, n = np.unique(code(tile, word), return_counts=True)
        tile, item = np.divmod(held, items)
        live = n >= self.need[item]
        return list(zip(item[live].tolist(), (tile * self.span[item])[live].tolist(), strict=True))


def contaminated(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, similarity, first_word, past_word): pairs of a document and a test
    item it holds a copy of, exact or edited."""
    keyed = lambda df, i, t: df.select(F.xxhash64(F.col(f"`{i}`"), F.col(f"`{t}`")).alias("key"), F.col(f"`{i}`").cast("long").alias("id"),
                                       F.col(f"`{t}`").alias("text")).where("text is not null")
    rows, tests = keyed(docs, id_col, text_col), keyed(benchmark, item_col, item_text_col)
    tests = stored(tests.dropDuplicates(["key"]), "tests")
    parts = 1 + (tests.agg(F.sum(F.length("text"))).first()[0] or 0) // PART_CHARS
    names = ["key", "doc_id", "item", "item_id", "score", "best", "first_word", "past_word"]

    def aligned(part: int) -> DataFrame:
        asked = tests.where(F.pmod("key", F.lit(parts)) == part).collect()  # about PART_CHARS characters
        items = [(r["key"], r["id"], hash_words(plain_words(r["text"]), {})) for r in asked]
        shared = rows.sparkSession.sparkContext.broadcast([x for x in items if len(x[2]) >= search.gram])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not shared.value:
                return
            seen: dict[bytes, int] = {}
            seeds, held, wide = Seeds([x[2] for x in shared.value], search), [], 0

            def out():
                done = align([seeds.items[h[2]] for h in held], [h[4] for h in held])
                found = [(h[0], h[1], *shared.value[h[2]][:2], s, MATCH * len(seeds.items[h[2]]), h[3] + a, h[3] + z) for h, (s, a, z) in zip(held, done, strict=True)
                         if s >= search.similar * MATCH * len(seeds.items[h[2]])]
                held.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * 8)], names=names)
            for b in batches:
                for key, i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    words = hash_words(plain_words(text.as_py()), seen)
                    for item, start in seeds.candidates(words):
                        passage = words[start:start + 2 * int(seeds.span[item])].copy()
                        wide = max(wide, len(passage))
                        held.append((key, i, item, start, passage))
                        if len(held) >= BATCH or len(held) * wide > CELLS:
                            yield out()
                            wide = 0
            if held:
                yield out()

        return map_arrow(rows, run, "key long, doc_id long, item long, item_id long, score long, best long, first_word long, past_word long")

    pairs = reduce(DataFrame.union, map(aligned, range(parts)))
    top = pairs.groupBy("key", "item").agg(F.max(F.struct("score", (-F.col("first_word")).alias("minus_first"), "past_word", "best", "doc_id", "item_id")).alias("t"))
    return top.select(F.col("t.doc_id").alias(id_col), F.col("t.item_id").alias(item_col), "t.score", (F.col("t.score") / F.col("t.best")).alias("similarity"),
                      (-F.col("t.minus_first")).alias("first_word"), "t.past_word")
