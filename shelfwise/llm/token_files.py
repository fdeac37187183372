"""Token-id files, entropy-coded by a static range asymmetric numeral system (rANS).

``write`` tokenises texts, sorts the documents by id over all partitions and writes

* ``table``: the frequency table all blocks share, scaled to a power of two; it is counted over
  all ids of the corpus, and every id that occurs has a slot;
* ``directory``: one row per block: part, block, ids before it in the part, ids, documents;
* ``ids/part=N/*.txt``: sequences of blocks. Parts ascend with the ids of the documents, and so do
  blocks inside a part.

A block holds whole documents, at least ``BLOCK`` ids (the last one of a part fewer), and is
decoded by itself: the header is a checkpoint (part, block, ids before it), followed by the list of
its documents, the states and the words of ``LANES`` interleaved coders, and a CRC-32 of all that and
of the ids. A damaged, cut or misplaced block raises ``ValueError``. Blocks are the unit of parallel
decoding: ``read`` decodes them wherever their files lie, ``read_range`` only those that hold the
asked stretch of ids, found in the directory.

The coders: id i of a block goes to lane i % LANES, so a step codes LANES ids at once (one array
operation). A 64-bit state gives off its low 32 bits when the next id would overflow it; encoding
runs from the last step to the first, so that decoding reads forward.

Tokenising: texts are cut at single spaces between two other characters (no token of the tokenizer
reaches over one, the next piece begins with that space), and the library encodes each distinct
piece once per worker while it is remembered; pieces over a line end are made of those of their lines.
Pieces of several texts are numbered by Arrow, and each distinct one is looked up once. ``Pieces``
proves both cuts on loading.

Edge cases: null texts are empty and have the end id alone. Null ids sort first and stay null.
Equal ids follow the hash of their texts; rows repeated as a whole are each written. An empty
table gives files without blocks and an empty result. Extra columns are ignored.
Scale: texts are shuffled once (by range); counts are summed in tasks before they are shuffled; the
driver holds the table (one row per distinct id, at most the vocabulary) and one number per part.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import forget, map_arrow, new_path

BLOCK, LANES = 1 << 18, 1024
#: Ids below this are looked up in an array.
DIRECT = 1 << 20
#: Blocks of a file at most (some 50 MB), so that a file fits in a task's memory.
FILE_BLOCKS = 128
#: Least state of a coder and bits of a scaled table (raised for vocabularies that need more).
LOW, SCALE_BITS = np.uint64(1 << 31), 18
MAGIC, SEPARATOR = b"RNS1", b"\n"
#: magic, part, block, ids before, ids, documents, words, scale bits, CRC-32 of header, body and ids
HEADER = struct.Struct("<4sIIQIIIII")
DOCUMENT = np.dtype([("has_id", "<u4"), ("n", "<u4"), ("id", "<i8")])
#: Remembered pieces of a worker (twice so many at most) and the longest one: memory bounds only.
REMEMBERED, LONGEST, SHORT_TAILS = 700_000, 64, 1000
#: Bytes of texts whose pieces are looked up together (one longer text is taken alone).
TOGETHER = 4 << 20


# ---- tokenising -----------------------------------------------------------------------------

_CUT = re.compile(r"(?<=\S) (?=\S)")
_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")
_PAIR = re.compile(r"\s\s")
#: Letters, then ASCII punctuation (an apostrophe may begin a word of its own, "<" a special token).
_WORD = re.compile(r"([^\W\d_]+)([!-&(-/:;=-@\[-`{-~]*)")


def _alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others, in order, for the
    code points from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Memory(dict):
    """Ids by piece; a piece that isn't there is made by ``new``."""

    def __init__(self, new):
        super().__init__()
        self.new = new

    def __missing__(self, piece: str) -> bytes:
        return self.new(piece)


class Pieces:
    """The tokenizers library behind a memory of pieces: the ids of a text are those of its pieces,
    and those of a piece are those of its lines (a line end between two other characters is a word of its
    own) and words (letters behind a space or line end, punctuation behind them)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model, self.split = self.whole.model, self.whole.pre_tokenizer
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.alphabet = _alphabet()
        self.now, self.before = _Memory(self._new), {}
        self.tails: dict[str, bytes] = {"": b""}
        self.line_end = b""
        probe = "a b, c 12 it's\n\n d  e \t é?! f <x> 'll   g h\n i ñandú — ²x x² 漢字。 "
        self.by_piece = self.whole.normalizer is None and self.split is not None and not any(map(str.isspace, "".join(self.special)))
        self.by_line = False
        self.by_piece = self.by_piece and all(self.encode(t) == self._encode(t) for t in (probe, probe.strip(), probe))
        if self.by_piece:
            self.line_end, self.by_line = self._word("\n"), True
            probe = "a.\nThe b, an\n'll a.\nThe, it\né\n\ng d!\n—x\n12\r\ny a\nb\n c\n.\nThe a"
            self.by_line = all(self.encode(t) == self._encode(t) for t in (probe, probe))
            if not self.by_line:
                self.now, self.before = _Memory(self._new), {}

    def _encode(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer."""
        shown = word if word.isascii() else word.encode().decode("latin-1")
        return array("I", [t.id for t in self.model.tokenize(shown.translate(self.alphabet))]).tobytes()

    def _new(self, piece: str) -> bytes:
        """Ids of a piece (without its leading space, or with the line end before it), remembered."""
        ids = self.before.get(piece)
        if ids is None:
            line = piece[0] == "\n"
            lead, space, rest = (self.line_end, "", piece[1:]) if line else (b"", " ", piece)
            m = _WORD.fullmatch(rest)
            if m and m[1].isalpha():
                word, tail = m.groups()
                key = "\n" + word if line else word
                ids = (self.now.get(key) or self.before.get(key)) if tail else None
                if ids is None:
                    ids = lead + self._word(space + word)
                    if tail:
                        self._remember(key, ids)
                end = self.tails.get(tail)
                if end is None:
                    end = self._word(tail)
                    if len(self.tails) < SHORT_TAILS and len(tail) < 4:
                        self.tails[tail] = end
                ids += end
            elif any(t in piece for t in self.special):
                ids = self._encode(space + piece)
            elif self.by_line and len(parts := _LINE_END.split(piece)) > 1:
                ids = self.now[parts[0]] + b"".join([self.now["\n" + x] for x in parts[1:]])
            else:
                ids = array("I", [t.id for w, _ in self.split.pre_tokenize_str(space + piece) for t in self.model.tokenize(w)]).tobytes()
        return self._remember(piece, ids)

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(piece) <= LONGEST:
            if len(self.now) >= REMEMBERED:
                self.before, self.now = self.now, _Memory(self._new)
            self.now[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text or not self.by_piece:
            return self._encode(text) if text else b""
        parts = text.split(" ") if _PAIR.search(text) is None and not text[0].isspace() and not text[-1].isspace() else _CUT.split(text)
        first = self._encode(parts[0]) if parts[0] else b""
        return first + b"".join(map(self.now.__getitem__, parts[1:]))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """:meth:`encode` of every text (null: empty). Texts are taken together up to ``TOGETHER`` bytes, so that
        a piece is looked up once for all its places in them."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, TOGETHER + (ends[at - 1] if at else 0), "right")))
            yield from self._together(texts.slice(at, stop - at))
            at = stop

    def _together(self, texts: pa.Array) -> list[bytes]:
        whole = [t or "" for t in texts.to_pylist()]
        if not self.by_piece:
            return [self.encode(t) for t in whole]
        # at every space of these a piece begins
        plain = [i for i, t in enumerate(whole) if t and _PAIR.search(t) is None and not t[0].isspace() and not t[-1].isspace()]
        if not plain:
            return [self.encode(t) for t in whole]
        parts = pc.split_pattern(texts.take(pa.array(plain)), " ")
        first = parts.offsets.to_numpy()
        distinct = parts.flatten().dictionary_encode()
        found = pa.array(map(self.now.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False)), pa.large_binary()).take(distinct.indices)
        ids, place = memoryview(found.buffers()[2] or b""), np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)
        after, end = place[first[:-1] - first[0] + 1].tolist(), place[first[1:] - first[0]].tolist()
        done = {i: self._encode(whole[i].split(" ", 1)[0]) + ids[a:z] for i, a, z in zip(plain, after, end, strict=True)}
        return [done[i] if i in done else self.encode(t) for i, t in enumerate(whole)]


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One tokenizer per worker and file; what it remembers outlives a task."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


# ---- coder ----------------------------------------------------------------------------------

class Table:
    """Scaled frequencies of the ids that occur (sorted)."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray, bits: int):
        self.ids, self.bits = ids.astype(np.uint32), bits
        self.freq = freqs.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.slots: np.ndarray | None = None
        self.place: np.ndarray | None = None

    @staticmethod
    def scaled(ids: np.ndarray, counts: np.ndarray) -> Table:
        """Every id gets a slot at least, the rest in proportion; the largest take up the rounding."""
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(np.float64)
        bits = max(SCALE_BITS, int(max(len(ids), 1)).bit_length() + 2)
        if bits > 28:
            raise ValueError("too many distinct ids")
        size = 1 << bits
        freq = 1 + np.floor(counts / max(counts.sum(), 1) * (size - len(ids))).astype(np.int64)
        if len(freq):
            freq[counts.argmax()] += size - freq.sum()
        return Table(ids, freq, bits)

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the ids; by an array where ids are small numbers, as those of a vocabulary are."""
        if len(self.ids) and self.ids[-1] < DIRECT:
            if self.place is None:
                self.place = np.full(DIRECT, len(self.ids), np.int32)
                self.place[self.ids] = np.arange(len(self.ids))
            k = self.place[np.minimum(ids.astype(np.uint32), np.uint32(DIRECT - 1))]
        else:
            k = np.searchsorted(self.ids, ids)
        if len(ids) and (k.max() >= len(self.ids) or (self.ids[k] != ids).any()):
            raise ValueError("an id without a slot in the table")
        return k

    def symbols(self) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self.slots


def rans_encode(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """(states, words) of the ids."""
    k = table.places(ids)
    freq, start, bits = table.freq[k], table.start[k], np.uint64(table.bits)
    full = freq << np.uint64(63 - table.bits)
    state, words = np.full(LANES, LOW, np.uint64), []
    for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES) if len(ids) else ():
        f = freq[at:at + LANES]
        x = state[:len(f)]
        over = x >= full[at:at + LANES]
        words.append(x[over].astype(np.uint32))
        x[over] >>= np.uint64(32)
        q = x // f
        x[:] = (q << bits) + (x - q * f) + start[at:at + LANES]
    return state, np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)


def rans_decode(n: int, state: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    out = np.empty(n, np.uint32)
    symbols, bits, mask = table.symbols(), np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state, words, used = state.copy(), words.astype(np.uint64), 0
    for at in range(0, n, LANES):
        x = state[:min(LANES, n - at)]
        slot = x & mask
        k = symbols[slot.astype(np.int64)]
        out[at:at + LANES] = table.ids[k]
        x[:] = table.freq[k] * (x >> bits) + slot - table.start[k]
        low = np.flatnonzero(x < LOW)
        if used + len(low) > len(words):
            raise ValueError("block is cut")
        x[low] = (x[low] << np.uint64(32)) | words[used:used + len(low)]
        used += len(low)
    if used != len(words) or (state != LOW).any():
        raise ValueError("block is damaged")
    return out


def pack_block(part: int, block: int, before: int, docs: np.ndarray, ids: np.ndarray, table: Table) -> bytes:
    state, words = rans_encode(ids, table)
    body = docs.astype(DOCUMENT).tobytes() + state.astype("<u8").tobytes() + words.astype("<u4").tobytes()
    fields = part, block, before, len(ids), len(docs), len(words), table.bits
    crc = zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(body, zlib.crc32(repr(fields).encode())))
    return HEADER.pack(MAGIC, *fields, crc) + body


def block_place(data: memoryview) -> tuple[int, int, int]:
    """(part, block, length) of the block that the data begin with, without decoding it."""
    if len(data) < HEADER.size or bytes(data[:4]) != MAGIC:
        raise ValueError("no block here")
    _, part, block, _, _, n_docs, n_words, _, _ = HEADER.unpack(data[:HEADER.size])
    return part, block, HEADER.size + n_docs * DOCUMENT.itemsize + LANES * 8 + n_words * 4


def unpack_block(data: memoryview, table: Table) -> tuple[int, int, int, np.ndarray, np.ndarray, int]:
    """(part, block, ids before, documents, ids, bytes read) of the block that the data begin with."""
    _, _, size = block_place(data)
    _, *fields, crc = HEADER.unpack(data[:HEADER.size])
    part, block, before, n, n_docs, n_words, bits = fields
    sizes = np.cumsum([HEADER.size, n_docs * DOCUMENT.itemsize, LANES * 8, n_words * 4])
    if len(data) < size or bits != table.bits:
        raise ValueError("block is cut or of another table")
    docs, state, words = (np.frombuffer(data[a:z], t) for a, z, t in zip(sizes, sizes[1:], (DOCUMENT, "<u8", "<u4"), strict=False))
    ids = rans_decode(n, state, words, table)
    if zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(data[sizes[0]:sizes[-1]], zlib.crc32(repr(tuple(fields)).encode()))) != crc or docs["n"].sum() != n:
        raise ValueError(f"checksum of part {part}, block {block}")
    return part, block, before, docs, ids, int(sizes[-1])


# ---- files ----------------------------------------------------------------------------------

def _blocks(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, block, before, n, docs, ids): documents in order of their ids, gathered to blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, part = pieces(tokenizer).encode_all, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        block, before, held, entries, size = 0, 0, [], [], 0

        def out():
            ids = np.frombuffer(b"".join(held), "<u4")
            small = ids.astype("<u2") if ids.max() < 1 << 16 else ids
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, block, before, len(ids))]
                                              + [pa.array([np.array(entries, DOCUMENT).tobytes()], pa.binary()), pa.array([small.tobytes()], pa.binary())],
                                              names=["part", "block", "before", "n", "docs", "ids"])
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encode_all(b.column(1)), strict=True):
                ids += end
                held.append(ids)
                entries.append((doc_id is not None, len(ids) // 4, doc_id or 0))
                size += len(ids) // 4
                if size >= BLOCK:
                    yield out()
                    block, before, held, entries, size = block + 1, before + size, [], [], 0
        if held:
            yield out()

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"), "hash").sortWithinPartitions(F.asc_nulls_first("doc_id"), "hash")
    return map_arrow(ordered.select("doc_id", "text"), run, "part long, block long, before long, n long, docs binary, ids binary")


def _ids(docs: bytes, ids: bytes) -> np.ndarray:
    n = int(np.frombuffer(docs, DOCUMENT)["n"].sum(dtype=np.int64))
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def _counts(blocks: DataFrame) -> DataFrame:
    """(id, n): how often every id occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for docs, ids in zip(*b.columns, strict=True):
                own = np.bincount(_ids(docs.as_py(), ids.as_py()))
                if len(own) > len(total):
                    own, total = total, own
                total[:len(own)] += own
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["id", "n"])
    return map_arrow(blocks.select("docs", "ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes the documents' ids, each followed by ``end_id``; returns the folder."""
    spark = docs.sparkSession
    scratch = new_path(spark, "token-blocks")
    # ids in a scratch table: the shared frequencies must be known before the first block is coded
    _blocks(docs, tokenizer, end_id, id_col, text_col).write.option("compression", "zstd").parquet(scratch)
    blocks = spark.read.parquet(scratch)
    counted = _counts(blocks).collect()  # a row per distinct id: the vocabulary at most
    table = Table.scaled(np.array([r["id"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64))
    (spark.createDataFrame([(int(i), int(f), table.bits) for i, f in zip(table.ids, table.freq, strict=True)], "id long, freq long, bits int")
     .coalesce(1).write.parquet(f"{path}/table"))
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, block, before, docs, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = pack_block(part, block, before, np.frombuffer(docs, DOCUMENT), _ids(docs, ids), shared.value)
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([block]), pa.array([data], pa.binary())], names=["part", "block", "data"])

    coded = map_arrow(blocks.select("part", "block", "before", "docs", "ids"), run, "part long, block long, data binary")
    (coded.sortWithinPartitions("part", "block").select("part", F.col("data").cast("string").alias("value")).write.partitionBy("part")
     .option("maxRecordsPerFile", FILE_BLOCKS).option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode()).text(f"{path}/ids"))
    (blocks.select("part", "block", "before", "n", F.expr(f"octet_length(docs) div {DOCUMENT.itemsize}").alias("n_docs")).write.parquet(f"{path}/directory"))
    forget(spark, scratch)
    return path


def _table(spark: SparkSession, path: str) -> Table:
    rows = sorted((r["id"], r["freq"], r["bits"]) for r in spark.read.parquet(f"{path}/table").collect())  # the vocabulary at most
    ids, freqs, bits = zip(*rows, strict=True) if rows else ((), (), (SCALE_BITS,))
    return Table(np.array(ids, np.int64), np.array(freqs, np.int64), bits[0])


def _decoded(spark: SparkSession, path: str, directory: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in the blocks that ``directory`` lists."""
    sizes = spark.read.parquet(f"{path}/directory").groupBy("part").agg(F.sum("n").alias("n")).collect()  # a row per part
    starts, total = {}, 0
    for r in sorted(sizes):
        starts[r["part"]], total = total, total + r["n"]
    if not starts:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    wanted = None if directory is None else {}
    if directory is not None:
        for r in directory.select("part", "block").collect():  # the blocks of one stretch of ids
            wanted.setdefault(r["part"], set()).add(r["block"])
    shared = spark.sparkContext.broadcast((_table(spark, path), starts, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts, wanted = shared.value
        for b in batches:
            for content in b.column(0):
                data = memoryview(content.as_buffer())
                while len(data):
                    if wanted is not None:
                        part, block, size = block_place(data)
                        if block not in wanted.get(part, ()):
                            data = data[size + len(SEPARATOR):]
                            continue
                    part, block, before, docs, ids, used = unpack_block(data, table)
                    n = docs["n"].astype(np.int64)
                    first = np.cumsum(n) - n
                    raw = ids.astype("<u4").tobytes()
                    at = (4 * np.r_[first, len(ids)]).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs["id"].astype(np.int64), mask=docs["has_id"] == 0), pa.array(starts[part] + before + first), pa.array(n),
                         pa.array([raw[i:j] for i, j in zip(at, at[1:], strict=False)], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                    if len(data) > used and bytes(data[used:used + len(SEPARATOR)]) != SEPARATOR:
                        raise ValueError("separator expected after a block")
                    data = data[used + len(SEPARATOR):]

    files = spark.read.format("binaryFile").load(f"{path}/ids").where("length > 0")
    if wanted is not None:
        files = files.where(F.col("part").isin(list(wanted)))
    return map_arrow(files.select("content"), run, "doc_id long, start long, n_tokens long, ids binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids are little-endian unsigned 32-bit integers."""
    return _decoded(spark, path, None)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """As :func:`read`, for the documents that hold any of the ids ``start`` to ``stop`` - 1 of the corpus;
    only blocks that hold some are decoded."""
    directory = spark.read.parquet(f"{path}/directory")
    at, total = [], 0
    for r in sorted(directory.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # a row per part
        at.append(f"(part = {r['part']} and before + {total} < {int(stop)} and before + n + {total} > {int(start)})")
        total += r["n"]
    hit = directory.where(" or ".join(a for a in at) if at else "false")
    return _decoded(spark, path, hit).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
