"""Fill-in-the-middle transformation over an indexable skip list.

A text is a sequence of units: runs of letters A-Z and a-z, and every other code point by itself.
Two cut ranks, counted in units, split it into prefix, middle and suffix, which are rearranged
around the sentinels ``<P>``, ``<S>`` and ``<M>``:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is: empty texts, texts that hold a sentinel (they could not be taken
  apart again), and the share that the plan leaves alone

Cuts are found in a :class:`SkipList` of the units. Its bottom lane has a link per unit; each
express lane keeps the links of about a quarter of the nodes below. Every link carries two widths,
units and code points, so descending by summed units arrives at a rank and has the code points
passed on the way: both cuts are exact, and neither counts the text's units one by one.
Lanes are arrays, and a lane is summed from the one below, so that building is linear.

The plan of a document comes from the SHA-256 of ``1:`` and its decimal id alone: it does not
depend on partitions, other rows or the order of rows. ``restore`` takes the output apart by its
sentinels: a sentinel cannot begin inside another one or across its edge, and the text holds none.

Edge cases: null and empty texts are plain with no units and an empty output. A null id hashes
like an empty one. Repeated rows and ids are treated alike, each by itself. Extra columns are
carried along as they are, whatever their names; those named like a result column are replaced.
Every row is handled where it lies: no shuffle, memory bounded by the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import map_arrow, mix64

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Plan:
    """Of 100 documents (by hash), ``transformed`` are cut, and of 100 of those ``spm`` get that form."""
    transformed: int = 90
    spm: int = 20

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))


class SkipList:
    """Indexable skip list over the units of a text of code points ``points``."""

    def __init__(self, points: np.ndarray):
        folded = points | 32
        letter = (folded >= 97) & (folded <= 122)
        starts = np.flatnonzero(~(letter & np.r_[False, letter[:-1]])) if len(points) else np.empty(0, np.int64)
        self.units = len(starts)
        # lane: (place in the lane below, units, code points) of every link; a node's height comes from its rank
        chars = np.diff(starts, append=len(points))
        self.lanes = [(np.arange(self.units), np.ones(self.units, np.int64), chars)]
        with np.errstate(over="ignore"):
            coin = mix64(np.arange(self.units, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        rank = np.arange(self.units)
        while len(rank) > 4:
            up = np.flatnonzero((rank == 0) | (coin[rank] & np.uint64(3) == 0))  # the head stands in every lane
            if len(up) == len(rank):
                break
            _, units, chars = self.lanes[-1]
            self.lanes.append((up, np.add.reduceat(units, up), np.add.reduceat(chars, up)))
            rank, coin = rank[up], coin >> np.uint64(2)

    def code_points_before(self, cut: int) -> int:
        """Code points of the first ``cut`` units, 0 <= cut <= units."""
        if not 0 <= cut <= self.units:
            raise IndexError(cut)
        at, units, chars = 0, 0, 0
        for k in range(len(self.lanes) - 1, -1, -1):
            below, wide, long = self.lanes[k]
            while at < len(wide) and units + wide[at] <= cut:
                units, chars, at = units + int(wide[at]), chars + int(long[at]), at + 1
            if units == cut:
                return chars
            at = int(below[at])
        raise AssertionError("the bottom lane has a link per unit")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rearranged(text: str | None, doc_id, plan: Plan = Plan()) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    text = text or ""
    parts = SkipList(_points(text))
    n = parts.units
    a, b, c, d = plan.draws(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or c % 100 >= plan.transformed:
        return n, "plain", None, None, text
    first, last = sorted((a % (n + 1), b % (n + 1)))
    i, j = parts.code_points_before(first), parts.code_points_before(last)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if d % 100 < plan.spm:
        return n, "spm", i, j - i, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", i, j - i, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns without the text, then n, form, prefix_chars, middle_chars and output."""
    added = [x.split()[0] for x in RESULT.split(", ")]
    kept = [c for c in docs.columns if c not in (text_col, *added)]
    packed = docs.select(F.col(f"`{id_col}`").cast("long").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"),
                         F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")])).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                done = [rearranged(t.as_py(), i, plan) for i, t in zip(part.column(0).to_pylist(), part.column(1), strict=True)]
                n, form, prefix, middle, out = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                                                  pa.array(middle, pa.int64()), pa.array(out, pa.string())], names=["row", *added])

    out = map_arrow(packed, run, T.StructType([packed.schema["row"], *T.StructType.fromDDL(RESULT)]))
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in kept), *added)


def restored(form: Column, output: Column) -> Column:
    """The exact text that ``transform`` was given."""
    def between(mark_a: str, mark_b: str) -> tuple[Column, Column, Column]:
        body = F.split(F.substr(output, F.lit(4)), mark_a, 2)
        rest = F.split(body[1], mark_b, 2)
        return body[0], rest[0], rest[1]
    prefix, suffix, middle = between(SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(PREFIX, MIDDLE)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
