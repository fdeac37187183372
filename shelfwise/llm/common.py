"""Helpers shared by the corpus operators: whole-text words, shared-folder tables,
fixed-size membership bitmaps and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space: every other code point belongs to a word ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


# ---- native columns -------------------------------------------------------------------------

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_col(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_GAP)))


def lines_col(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


# ---- Python-side words ----------------------------------------------------------------------

def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a whole text as UTF-8 bytes. ``bytes.split`` cuts at exactly the six ASCII
    white-space bytes and ``bytes.lower`` changes exactly A-Z."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes], seen: dict[bytes, int], most: int = 300_000) -> np.ndarray:
    """64-bit hashes of words. ``seen`` remembers hashes and is emptied when it holds ``most``
    entries, so that it stays bounded whatever the vocabulary."""
    from xxhash import xxh3_64_intdigest as h
    if len(seen) > most:
        seen.clear()
    out = np.fromiter(map(seen.get, words, _repeat(-1)), dtype=np.int64, count=len(words)) if words else np.empty(0, np.int64)
    for i in np.flatnonzero(out == -1):
        w = words[i]
        v = seen.get(w)
        if v is None:
            v = h(w)
            v = seen[w] = v - (1 << 64) if v >= 1 << 63 else v
        out[i] = v
    return out.view(np.uint64)


def _repeat(x):
    while True:
        yield x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_GAP = np.isin(np.arange(256), list(SPACES.encode()))
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): 64-bit hashes of the words of many texts, which are those of :func:`words_of` in lower
    case, one text after the other, and where each text's end. Null texts have none. All words are
    hashed at once, eight bytes a step; these are other hashes than those of :func:`hash_words`."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or at[0] == at[-1]:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    raw = np.concatenate([_LOWER[np.frombuffer(data, np.uint8)[at[0]:at[-1]]], np.zeros(8, np.uint8)])
    at = at - at[0]
    word = ~_GAP[raw[:-8]]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = at[(at > 0) & (at < at[-1])]  # a text's end ends a word
    first[cuts], last[cuts - 1] = word[cuts], word[cuts - 1]
    begin = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - begin
    lanes = np.ndarray(len(word) + 1, "<u8", raw, strides=(1,))
    h, left, done = mix64(size.astype(np.uint64)), np.arange(len(size)), 0
    with np.errstate(over="ignore"):
        while len(left):
            x = lanes[begin[left] + done] & _LOW_BYTES[np.minimum(size[left] - done, 8)]
            h[left] = mix64(h[left] * _MUL + x)
            done += 8
            left = left[size[left] > done]
    return h, np.searchsorted(begin, at[1:])


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (empty when there are fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.full(m, np.uint64(n), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = mix64(out * _MUL + h[j:j + m])
    return out


def long_gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """As :func:`gram_hashes` for long runs: hashes of runs of doubling lengths are combined,
    so the work per position is logarithmic in ``n``."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        size, power = 1, mix64(h + _MUL)
        out, done = None, 0
        while True:
            if n & size:
                part = power[done:done + m]
                out = part if out is None else mix64(out * _MUL + part)
                done += size
            if done == n:
                return out
            power = mix64(power[:-size] * _MUL + power[size:])
            size *= 2


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---- tables in the shared folder ------------------------------------------------------------

def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else the session's warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir or spark.sql.warehouse.dir")
    return path.rstrip("/")


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, or in that of the operator call that is going on."""
    return f"{_FOLDER.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage is cut, and lost executors
    cost only the tasks that read it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete tables of the shared folder that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written and read back. All tables that it stores on the way lie in one folder, which
    is deleted when the result is written (or the call fails)."""
    path, folder = new_path(spark, name), new_path(spark, f"{name}-tables")
    before = _FOLDER.set(folder)
    try:
        df = build()
        df.write.parquet(path)
    finally:
        _FOLDER.reset(before)
        forget(spark, folder)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is not among ``ids`` (a stored one-column table of longs), in the columns of
    ``df``. Only rows that a bitmap of fixed size holds are shuffled for the exact join; null ids stay."""
    whole = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"))
    ids = ids.toDF("id")
    bitmap = place_bitmap(ids, F.xxhash64("id"))
    some = maybe_in(whole, F.xxhash64("id"), bitmap).join(ids, "id", "left_anti")
    return maybe_in(whole, F.xxhash64("id"), bitmap, inside=False).select("row.*").union(some.select("row.*"))


# ---- fixed-size bitmaps ---------------------------------------------------------------------

def place_bitmap(df: DataFrame, key: Column, log2_bits: int = 23) -> DataFrame:
    """One row with a bitmap of 2**log2_bits bits (an array of longs) in which the top bits of every
    64-bit ``key`` are set: native twin of :func:`hash_bitmap`, of the same fixed size."""
    top = F.shiftrightunsigned(key, 64 - log2_bits)
    words = df.select(F.shiftright(top, 6).alias("id"), top.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    every = df.sparkSession.range(1 << log2_bits - 6).join(words, "id", "left").agg(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("a"))
    return every.select(F.col("a.bits").alias("_bitmap"))


def maybe_in(df: DataFrame, key: Column, bitmap: DataFrame, inside: bool = True, log2_bits: int = 23) -> DataFrame:
    """The rows of ``df`` whose key the bitmap holds, or takes for one that it holds; or the others."""
    top = F.shiftrightunsigned(key, 64 - log2_bits)
    marked = df.withColumn("_word", F.shiftright(top, 6).cast("int")).withColumn("_bit", top.bitwiseAND(F.lit(63)).cast("int"))
    hit = F.expr(f"shiftright(element_at(_bitmap, _word + 1), _bit) & 1 = {1 if inside else 0}")
    return marked.join(F.broadcast(bitmap), hit).drop("_word", "_bit", "_bitmap")


def hash_bitmap(df: DataFrame, hash_col: str, log2_bits: int = 23) -> np.ndarray:
    """A bitmap of 2**log2_bits bits with the top bits of each 64-bit hash set (one-hash Bloom
    filter). Its size does not depend on the data, so collecting and broadcasting it is bounded
    (2**23 bits: 1 MB); false positives are removed by the exact joins that follow."""
    top = F.shiftrightunsigned(F.col(hash_col), 64 - log2_bits)
    rows = (df.select(F.shiftright(top, 15).cast("long").alias("_bucket"), (top % 32768).cast("long").alias("_bit"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")).collect())
    out = np.zeros(1 << max(log2_bits - 3, 12), np.uint8)
    for r in rows:
        out[r[0] * 4096:(r[0] + 1) * 4096] = np.frombuffer(r[1], np.uint8)
    return out


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    log2_bits = int(len(bits) * 8).bit_length() - 1
    top = h >> np.uint64(64 - log2_bits)
    return (bits[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8)) & 1 == 1


def id_hash(ids: np.ndarray) -> np.ndarray:
    """Hash of integer ids for :func:`in_bitmap`; :func:`id_hash_col` is its Spark twin."""
    with np.errstate(over="ignore"):
        return (ids.astype(np.int64).view(np.uint64) * _MUL)


def lowest(df: DataFrame, key: Column, k: int) -> DataFrame:
    """Rows that hold the ``k`` of lowest 64-bit ``key`` (an evenly spread hash) and few others: the cut-off
    is read off counts by the key's top 16 bits, so that a later ``orderBy(key).limit(k)`` sends some
    ``k`` rows in all, not ``k`` from every partition."""
    top = F.shiftright(key, 48)
    at, cut = 0, None
    for r in sorted(df.groupBy(top.alias("top")).agg(F.count(F.lit(1)).alias("n")).collect()):  # 65,536 rows at most
        at, cut = at + r["n"], r["top"]
        if at >= k:
            break
    return df if cut is None else df.where(top <= cut)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(schema: str, **cols) -> pa.RecordBatch:
    """Record batch from arrays; ``schema`` is 'name type, ...' with long/int/double/string/boolean/binary."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32()}
    names, arrays = [], []
    for part in schema.split(","):
        name, kind = part.split()
        v = cols[name]
        names.append(name)
        arrays.append(v if isinstance(v, pa.Array) else pa.array(v, type=kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names=names)


# ---- connected components -------------------------------------------------------------------

def components(edges: DataFrame, u: str = "u", v: str = "v", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge; root is the smallest node reachable.

    Alternating large-star / small-star contraction (Kiveris et al., 2014): every round is two
    joins on the remaining edges, written to the shared folder. Minimum neighbours are partial
    aggregates, so a hub does not gather its neighbours in one task. No edges: an empty result.
    It has settled when every node has one neighbour only, which has none of its own above it: that is
    looked up, as one more round would cost far more. Raises after ``most_rounds`` rounds (it takes O(log^2 n)).
    """
    e = (edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
         .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, "edges")
        ends = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")).distinct())
        if ends.groupBy("u").agg(F.count("v").alias("above"), F.count(F.lit(1)).alias("n")).where("above > 0 and n > 1").isEmpty():
            break
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def joined_components(known: DataFrame, edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) as :func:`components` gives it for the edges of ``known``, its result for others, and
    ``edges``: only the roots that these connect are contracted. All nodes of ``known`` stay."""
    ends = edges
    for c in (u, v):
        ends = ends.join(known.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    top = stored(components(stored(ends.select(F.col(f"{u}_root").alias("u"), F.col(f"{v}_root").alias("v")).where("u <> v").distinct(), "edges")), "roots")
    every = known.union(top.select("node", F.col("node").alias("root")).join(known, "node", "left_anti"))
    return every.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
