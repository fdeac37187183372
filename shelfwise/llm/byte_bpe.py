"""Byte-level BPE: encoding and decoding of whole texts by a rank file.

A text is cut by the tokenizer's pattern and every piece is encoded by itself. Piece bytes are
mapped to Latin-1, one character per byte, so that an Aho-Corasick automaton over the vocabulary
finds the longest tokens. A token sequence is the merge result exactly if every two neighbours
are: for two tokens this is decided once, from how the merges inside each of them interleave with
the merges across their border, and remembered. Encoding tries the greedy longest tokens first;
where neighbours do not fit it backtracks to the next shorter token. A position from which nothing
fits is never entered again, so each piece takes time linear in its length.

Texts are first cut before every space that follows a non-space: the patterns of this family join
a space only to what comes after it, so no piece crosses such a cut, and what the pattern makes of
a spaced word is remembered per word.

Nulls and empty texts: no ids. Ids are packed as little-endian unsigned 32-bit integers. Rows are
handled one by one: repeated rows repeat, extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_arrow

#: Remembered words and token pairs per worker; a memory bound only (emptied when full).
WORDS_KEPT = 400_000
PAIRS_KEPT = 500_000
#: Result batches are passed on at this size, so that long texts do not pile up.
BATCH_BYTES = 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


assert array("I").itemsize == 4 and sys.byteorder == "little"


class Codec:
    """Encoder and decoder of one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.space = regex.compile(r"\s").match
        self.fits: dict[tuple[int, int], bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.borders: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.longest = max(map(len, ranks))

    def merged(self, raw: bytes) -> list[bytes]:
        """Plain merging, to two parts at least: join the neighbours of lowest rank, leftmost
        first, until none is left or two parts remain."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        rank = self.ranks.get
        while len(parts) > 2:
            options = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
            if not options:
                break
            i = min(options)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def split(self, a: int) -> tuple[int, int] | None:
        """The two tokens that merge into ``a`` (None: a single byte, or no merge gives ``a``)."""
        if a not in self.splits:
            parts = self.merged(self.tokens[a])
            self.splits[a] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.splits[a]

    def is_whole(self, a: int) -> bool:
        """Whether merging a token's bytes gives that token (some vocabularies hold others)."""
        return len(self.tokens[a]) == 1 or self.split(a) is not None

    def border(self, a: int, side: int) -> list[int]:
        """The tokens at an edge of ``a`` while it is merged, first to last (side 0: its left edge)."""
        known = self.borders[side].get(a)
        if known is None:
            parts = self.split(a)
            known = self.borders[side][a] = (self.border(parts[side], side) if parts else []) + [a]
        return known

    def pair_fits(self, a: int, b: int) -> bool:
        """Whether merging the joined bytes of two tokens leaves these two. Between two merges, the
        tokens at the border are one of ``a``'s right edge and one of ``b``'s left edge; the pair
        breaks if they would merge before either is merged into its own token."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > PAIRS_KEPT:
                self.fits.clear()
            known = self.fits[a, b] = self.is_whole(a) and self.is_whole(b) and self._holds(self.border(a, 1), self.border(b, 0))
        return known

    def _holds(self, x: list[int], y: list[int]) -> bool:
        never = len(self.ranks) + max(x[-1], y[-1]) + 1
        i = j = 0
        while True:
            next_x = x[i + 1] if i + 1 < len(x) else never
            next_y = y[j + 1] if j + 1 < len(y) else never
            across = self.ranks.get(self.tokens[x[i]] + self.tokens[y[j]])
            if across is not None and across < next_x and across <= next_y:  # of equal ranks the leftmost merges first
                return False
            if next_x == next_y == never:
                return True
            if next_x <= next_y:
                i += 1
            else:
                j += 1

    def encode_piece(self, raw: bytes) -> list[int]:
        one = self.ranks.get(raw)
        if one is not None:
            return [one]
        text, known, done, last = raw.decode("latin-1"), self.fits.get, 0, -1
        out: list[int] = []
        for _, (rank, n) in self.automaton.iter_long(text):
            if last >= 0:
                ok = known((last, rank))
                if not (self.pair_fits(last, rank) if ok is None else ok):
                    break
            elif not self.is_whole(rank):
                break
            out.append(rank)
            last = rank
            done += n
        return out if done == len(raw) else self.backtrack(raw, text, out, done)

    def backtrack(self, raw: bytes, text: str, out: list[int], at: int) -> list[int]:
        """Goes on from tokens that fit, up to byte ``at``."""
        rank_of, known, length = self.ranks.get, self.fits.get, self.automaton.longest_prefix
        dead: set[int] = set()
        most = 0
        while at < len(raw):
            n = most or length(text[at:at + self.longest])
            last = out[-1] if out else -1
            while n:
                rank = rank_of(raw[at:at + n])
                if rank is not None and at + n not in dead:
                    ok = known((last, rank)) if out else self.is_whole(rank)
                    if self.pair_fits(last, rank) if ok is None else ok:
                        out.append(rank)
                        at += n
                        most = 0
                        break
                n -= 1
            else:
                dead.add(at)
                if not out:
                    raise ValueError("the vocabulary lacks single bytes of the text")
                n = len(self.tokens[out.pop()])
                at -= n
                most = n - 1
                if not most:
                    dead.add(at)
        return out

    def pack(self, text: str) -> bytes:
        kept, out = self.pieces, []
        for p in self.find(text):
            ids = kept.get(p)
            if ids is None:
                if len(kept) > WORDS_KEPT:
                    kept.clear()
                ids = kept[p] = array("I", self.encode_piece(p.encode("utf-8"))).tobytes()
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        kept, out, open_ = self.words, [], None
        first, *words = text.split(" ")
        if first and not self.space(first[-1]):
            out.append(self.pack(first))
        else:
            open_ = first  # ends in white space, which may go on after the cut
        for w in words:
            if open_ is None:
                ids = kept.get(w)
                if ids is not None:
                    out.append(ids)
                    continue
            if not w or self.space(w[-1]):
                open_ = " " + w if open_ is None else f"{open_} {w}"
            elif open_ is not None:
                out.append(self.pack(f"{open_} {w}"))
                open_ = None
            else:
                if len(kept) > WORDS_KEPT:
                    kept.clear()
                ids = kept[w] = self.pack(" " + w)
                out.append(ids)
        if open_ is not None:
            out.append(self.pack(open_))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, Codec] = {}


def _codec(ranks: bytes, pattern: str) -> Codec:
    """The worker's codec; automata are built once a worker and vocabulary."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _CODECS:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        _CODECS[key] = Codec(table, pattern)
    return _CODECS[key]


def _mapped(df: DataFrame, id_col: str, from_col: str, to: tuple[str, ...], rank_file: str, pattern: str) -> DataFrame:
    with open(rank_file, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: its size is fixed, about 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        work = {("ids",): lambda x: (codec.encode(x),), ("decoded",): lambda x: (codec.decode(x),),
                ("ids", "decoded"): lambda x: ((ids := codec.encode(x)), codec.decode(ids))}[to]
        for b in batches:
            keys, done, held, start = b.column(0), [], 0, 0
            for i, value in enumerate(b.column(1)):
                x = value.as_py()
                done.append(work(x) if x else (b"",) * len(to))
                held += sum(map(len, done[-1]))
                if held > BATCH_BYTES or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([keys.slice(start, len(done)), *(pa.array(c, pa.binary()) for c in zip(*done, strict=True))],
                                                     names=[id_col, *to])
                    start, done, held = i + 1, [], 0

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(F.col(f"`{id_col}`"), F.col(f"`{from_col}`")), run,
                     ", ".join([f"`{id_col}` {kind}", *(f"{c} binary" for c in to)]))


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): packed token ids of every whole text. No shuffle."""
    return _mapped(docs, id_col, text_col, ("ids",), rank_file, pattern)


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary): the bytes of packed token ids."""
    return _mapped(encoded, id_col, ids_col, ("decoded",), rank_file, pattern)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary, decoded binary) in one pass: each text's ids, and the bytes they decode to."""
    return _mapped(docs, id_col, text_col, ("ids", "decoded"), rank_file, pattern)
