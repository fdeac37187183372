"""Repeated passages across documents: seed and extend.

A window is ``length`` consecutive words. Winnowing picks in each window the smallest hash of its
``seed`` words as its anchor, so equal windows have equal anchors. Documents meet on the anchors
that more than one of them has (the seeds); around each shared anchor the document is extended to
every window with that anchor, and windows are compared. A window that also starts in a document
with a smaller id is a repeat; consecutive repeats are joined to maximal passages, which are
removed from all but the first document.

Hot passages: a map task passes on each distinct window once (for the smallest id it has seen) and
settles the others itself, so a passage in a third of all documents reaches a reducer once a task.
Hot anchors: a phrase shorter than a window, but with an anchor, gives as many different windows as
documents. The windows of an anchor that over ``HOT`` documents hold (looked up in a bitmap of fixed
size) are dealt singly by their own hash; equal windows share anchor and hash, so they still meet.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null and empty texts have none. Documents are judged
on the input. Rows sharing an id do not count as smaller than each other, and each keeps its own
text; rows with a null id are returned as they are and are no source for others. Extra columns are
ignored. Windows are equal when their 64-bit hashes are (below ``HOT``, their anchors' as well).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import as_long, hash_bitmap, hash_words, in_bitmap, long_gram_hashes, map_arrow, stored, words_of

#: Windows a map task remembers to settle repeats itself; a memory bound only (emptied when full).
REMEMBERED = 1_000_000
ROWS = 20_000
#: Documents an anchor's windows may come from before they are dealt by their own hashes.
HOT = 128


def anchors(h: np.ndarray, seed: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position of each window, hashes of all seeds) of one document's word hashes."""
    grams = long_gram_hashes(h, seed)
    span = length - seed + 1
    if len(grams) < span:
        return np.empty(0, np.int64), grams
    low = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
    return low + np.arange(len(low)), grams


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (first, past last) of sorted positions."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + 1).tolist(), strict=True))


def windows_met(docs: DataFrame, length: int = 50, seed: int = 16, id_col: str = "doc_id", text_col: str = "text",
                log2_bits: int = 25) -> DataFrame:
    """(doc_id, tag, first, past, meet, hashes): runs of windows with a shared anchor. Without ``meet``
    they repeat a smaller id; else windows of equal ``meet`` are to be compared by their hashes."""
    if not 0 < seed <= length:
        raise ValueError("0 < seed <= length")
    rows = _keyed(docs, id_col, text_col).where("doc_id is not null and text is not null")

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for b in batches:
            ids, found = [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                at, grams = anchors(hash_words(words_of(text.as_py()), seen), seed, length)
                own = np.unique(grams[np.unique(at)])
                ids.append(np.full(len(own), d, np.int64))
                found.append(own)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(as_long(np.concatenate(found)))], names=["doc_id", "anchor"])

    shared = stored(map_arrow(rows, seeds, "doc_id long, anchor long").groupBy("anchor")
                    .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count(F.lit(1)).alias("n")).where("a < z").select("anchor", (F.col("n") > HOT).alias("hot")), "anchors")
    sc = rows.sparkSession.sparkContext
    bits = sc.broadcast(hash_bitmap(shared, "anchor", log2_bits))  # 2**log2_bits bits, whatever the corpus
    hot_bits = sc.broadcast(hash_bitmap(shared.where("hot"), "anchor", log2_bits))  # as large

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        first: dict[int, int] = {}
        for b in batches:
            out = []
            for d, tag, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                h = hash_words(words_of(text.as_py()), words)
                at, grams = anchors(h, seed, length)
                if not len(at):
                    continue
                key = grams[at]
                starts = np.flatnonzero(in_bitmap(bits.value, key))
                if not len(starts):
                    continue
                if len(first) > REMEMBERED:
                    first.clear()
                whole = as_long(long_gram_hashes(h, length)[starts])
                known = np.fromiter((_known(first, x, d) for x in whole.tolist()), bool, len(whole))
                out += [(d, tag, a, z, None, None) for a, z in _runs(starts[known])]
                open_, own = starts[~known], whole[~known]
                hot = in_bitmap(hot_bits.value, key[open_])
                out += [(d, tag, k, k + 1, x, x.to_bytes(8, sys.byteorder, signed=True)) for k, x in zip(open_[hot].tolist(), own[hot].tolist(), strict=True)]
                open_, own = open_[~hot], own[~hot]
                cut = np.flatnonzero((np.diff(open_) != 1) | (np.diff(at[open_]) != 0)) + 1
                out += [(d, tag, int(s[0]), int(s[-1]) + 1, int(as_long(key[s[:1]])[0]), x.tobytes())
                        for s, x in zip(np.split(open_, cut), np.split(own, cut), strict=True) if len(s)]
                if len(out) > ROWS:
                    yield _window_batch(out)
                    out = []
            if out:
                yield _window_batch(out)

    return map_arrow(rows, windows, "doc_id long, tag long, first long, past long, meet long, hashes binary")


def repeats(docs: DataFrame, length: int = 50, seed: int = 16, id_col: str = "doc_id", text_col: str = "text",
            log2_bits: int = 25) -> DataFrame:
    """(doc_id, tag, first, past): runs of window starts that repeat a document with a smaller id.
    ``tag`` tells apart rows that share an id."""
    found = stored(windows_met(docs, length, seed, id_col, text_col, log2_bits), "windows")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meet, first = None, {}
        for b in batches:
            out = []
            for d, tag, start, m, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if m != meet:
                    meet, first = m, {}
                known = [start + i for i, x in enumerate(np.frombuffer(packed, np.int64).tolist()) if _known(first, x, d)]
                out += [(d, tag, p, q) for p, q in _runs(np.array(known, np.int64))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "tag", "first", "past"])

    open_ = found.where("meet is not null").select("doc_id", "tag", "first", "meet", "hashes")
    met = open_.repartition("meet").sortWithinPartitions("meet", "doc_id", "tag", "first")
    return found.where("meet is null").select("doc_id", "tag", "first", "past").union(
        map_arrow(met, settle, "doc_id long, tag long, first long, past long"))


def _known(first: dict[int, int], window: int, doc: int) -> bool:
    """Whether a smaller document had this window; otherwise ``doc`` is noted as the smallest so far."""
    d = first.get(window)
    if d is not None and d < doc:
        return True
    first[window] = doc
    return False


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["doc_id", "tag", "first", "past", "meet", "hashes"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("tag"),
                       F.col(f"`{text_col}`").alias("text"))


def dedup(docs: DataFrame, length: int = 50, seed: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, passages, kept): one row per input row.

    ``passages`` are the removed maximal passages [first word, past last); ``kept`` holds the words
    left, joined by one space. A document's passages are gathered per document, so they are bounded
    by its length.
    """
    spans = (repeats(docs, length, seed, id_col, text_col).groupBy("doc_id", "tag")
             .agg(F.collect_list(F.struct("first", "past")).alias("runs")))
    joined = _keyed(docs, id_col, text_col).join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string()]
        for b in batches:
            out, held = [], 0
            for d, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                words, passages = words_of(text.as_py()), []
                for r in sorted((r["first"], r["past"] + length - 1) for r in runs or []):
                    if passages and r[0] <= passages[-1][1]:
                        passages[-1][1] = max(passages[-1][1], r[1])
                    else:
                        passages.append(list(r))
                left, at = [], 0
                for a, z in passages:
                    left += words[at:a]
                    at = z
                left += words[at:]
                out.append((d, len(words), len(words) - len(left), passages, b" ".join(left).decode("utf-8", "surrogatepass")))
                held += len(out[-1][4])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     names=["doc_id", "n_words", "n_removed", "passages", "kept"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=["doc_id", "n_words", "n_removed", "passages", "kept"])

    return map_arrow(joined, cut, "doc_id long, n_words long, n_removed long, passages array<array<long>>, kept string")
