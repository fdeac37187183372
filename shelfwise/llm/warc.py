"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record, so that every record can be read by itself.
Of records with equal payloads the one with the largest id is the ``response``, the others are
``revisit`` records that name it; payloads below ``min_bytes`` are never revisits.
``read_archives`` parses whole archives back, with the place of every record.
``build_index`` sorts captures by reversed-host URL key, packs runs of lines into compressed
blocks and keeps one directory line per block; ``lookup`` binary-searches the bounds of the
directory's parts, then the block's lines; ``fetch`` reads only the byte ranges found.

Archives are written by Spark's text writer. Its record separator is an empty gzip member, so each
file is a plain sequence of gzip members, readable by any WARC tool.

Nulls: a null payload is an empty one, a null URL has no target header and the key ``''``; a null
id is written as ``null`` and read back as null. Rows repeated with the same id and payload are
each written. Extra columns are ignored. No pages: no archives, an empty index, empty results.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_arrow, new_path, stored

#: An archive's aimed size in payload bytes, and the lines of an index block and of an index part.
ARCHIVE_BYTES = 16 << 20
BLOCK_LINES = 3000
PART_LINES = 200_000
#: Archives are unpacked in such pieces, as what follows a member in its last piece is copied.
PIECE_BYTES = 4096
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
CAPTURE = ("page_id long, url_key string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, archive string, record_offset long, record_length long")


# ---- records --------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query (``org,example)/a?b``)."""
    if not url:
        return ""
    rest = url.split("#", 1)[0].split("://", 1)[-1]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    name, _, port = host.partition(":")
    port = "" if port in ("", "80", "443") else f":{port}"
    return ",".join(reversed(name.strip(".").split("."))) + port + ")" + (path if path.startswith("/") else "/" + path)


def _record(page_id, url, html, sha1: bytes, response_id) -> bytes:
    payload = (html or "").encode("utf-8")
    revisit = response_id is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda x: f"<urn:page:{'null' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
            "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(response_id)}"]
    return gzip.compress("\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _parse(raw: bytes) -> dict:
    """A record's capture fields and its payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda x: None if x is None or x == "<urn:page:null>" else int(x[len("<urn:page:"):-1])
    return {"page_id": number(fields["WARC-Record-ID"]), "url_key": url_key(fields.get("WARC-Target-URI")), "payload_bytes": size,
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
            "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload if fields["WARC-Type"] == "response" else None}


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members that hold something."""
    at, view = 0, memoryview(data)
    while at < len(data):
        step, content, end = zlib.decompressobj(31), [], at
        while not step.eof and end < len(data):
            piece = view[end:end + PIECE_BYTES]
            content.append(step.decompress(piece))
            end += len(piece)
        end -= len(step.unused_data)
        if any(content):
            yield at, end - at, b"".join(content)
        at = end


# ---- archives -------------------------------------------------------------------------------

def write_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> str:
    """Write the pages' records; returns the folder. Equal payloads are found by SHA-1 and length
    with a partial maximum per payload, so a payload that a third of all pages share is not gathered."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    html = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"),
                        F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).cast("long").alias("size"))
    heads = stored(rows.groupBy("page_id", "sha1", "size").agg(F.count(F.lit(1)).alias("n")), "payloads")
    total = heads.agg(F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0))).first()[0]
    best = heads.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("k"))
    marked = (heads.join(best.where("k > 1").drop("k"), ["sha1", "size"], "left")
              .where("response_id is not null and not (page_id <=> response_id)").select("page_id", "sha1", "response_id"))
    files = max(1, -(-total // ARCHIVE_BYTES))
    # revisits are sorted in front of their pages, so that pages are shuffled only once
    key = F.xxhash64("page_id", "sha1").alias("key")
    both = (marked.select(key, F.lit(0).alias("kind"), "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha1", "response_id")
            .unionByName(rows.select(key, F.lit(1).alias("kind"), "page_id", "url", "html", "sha1", F.lit(None).cast("long").alias("response_id"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, revisits = None, {}
        for b in batches:
            out = []
            for key, kind, page_id, url, html, sha1, response_id in zip(*b.columns, strict=True):
                if (k := key.as_py()) != now:
                    now, revisits = k, {}
                page = page_id.as_py(), sha1.as_py()
                if kind.as_py() == 0:
                    revisits[page] = response_id.as_py()
                else:
                    out.append(_record(page[0], url.as_py(), html.as_py(), bytes.fromhex(page[1]), revisits.get(page)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = map_arrow(both.repartition(files, "key").sortWithinPartitions("key", "kind"), run, "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))
    return path


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives as a capture row, with its archive, offset and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(CAPTURE)
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for at, n, content in _members(data.as_buffer().to_pybytes()):
                    rows.append(_parse(content) | {"archive": name, "record_offset": at, "record_length": n})
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return map_arrow(files.where("length > 0").select("path", "content"), run, CAPTURE)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


# ---- index ----------------------------------------------------------------------------------

def build_index(captures: DataFrame) -> dict[str, DataFrame]:
    """``blocks`` (block_id, data) and their ``directory`` (part, block_id, first_key, last_key).

    Captures are sorted by (key, id) over all partitions, so even a URL with very many captures is
    spread over blocks. Each partition packs its lines by itself.
    """
    n = captures.count()
    parts = max(1, -(-n // PART_LINES))
    ordered = (captures.select("url_key", "page_id", "archive", "record_offset", "record_length")
               .repartitionByRange(parts, "url_key", "page_id", "archive", "record_offset")
               .sortWithinPartitions("url_key", "page_id", "archive", "record_offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, rows = TaskContext.get().partitionId(), 0, []

        def block():
            data = gzip.compress("\n".join(json.dumps(r, ensure_ascii=False) for r in rows).encode("utf-8", "surrogatepass"), mtime=0)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(part << 32) + k], pa.int64()), pa.array([rows[0][0]]),
                                               pa.array([rows[-1][0]]), pa.array([data], pa.binary())],
                                              names=["part", "block_id", "first_key", "last_key", "data"])
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows.append(row)
                if len(rows) == BLOCK_LINES:
                    yield block()
                    rows, k = [], k + 1
        if rows:
            yield block()

    packed = stored(map_arrow(ordered, run, "part int, block_id long, first_key string, last_key string, data binary"), "capture-index")
    return {"blocks": packed.select("block_id", "data"), "directory": packed.drop("data")}


def lookup(index: dict[str, DataFrame], keys: DataFrame, key_col: str = "url_key") -> DataFrame:
    """(url_key, page_id, archive, record_offset, record_length) of all captures of the keys.

    The driver holds one pair of keys per index part (PART_LINES captures each); keys are searched
    among them, joined with the blocks of that part, and searched in the block's sorted lines.
    """
    spark = keys.sparkSession
    bounds = index["directory"].groupBy("part").agg(F.min("first_key").alias("a"), F.max("last_key").alias("z")).orderBy("part").collect()
    shared = spark.sparkContext.broadcast(([r["part"] for r in bounds], [r["a"].encode() for r in bounds], [r["z"].encode() for r in bounds]))
    wanted = keys.select(F.col(f"`{key_col}`").alias("key")).where("key is not null").distinct()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, first, last = shared.value
        for b in batches:
            key, part = [], []
            for k in b.column(0).to_pylist():
                x = k.encode()
                for p in range(bisect.bisect_left(last, x), bisect.bisect_right(first, x)):
                    key.append(k)
                    part.append(numbers[p])
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(part, pa.int32())], names=["key", "part"])

    found = (map_arrow(wanted, parts, "key string, part int").join(index["directory"], "part")
             .where("first_key <= key and key <= last_key").groupBy("block_id").agg(F.collect_set("key").alias("keys")))  # a block has at most BLOCK_LINES keys

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow("url_key string, page_id long, archive string, record_offset long, record_length long")
        for b in batches:
            for keys, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [json.loads(x) for x in gzip.decompress(data).decode("utf-8", "surrogatepass").split("\n")]
                at = [r[0].encode("utf-8", "surrogatepass") for r in rows]
                hits = []
                for k in keys:
                    x = k.encode()
                    hits += rows[bisect.bisect_left(at, x):bisect.bisect_right(at, x)]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in hits], schema=schema)

    return map_arrow(found.join(index["blocks"], "block_id").select("keys", "data"), lines,
                     "url_key string, page_id long, archive string, record_offset long, record_length long")


def fetch(places: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records at (archive, record_offset, record_length): capture rows, and payloads if asked for."""
    schema = CAPTURE + (", payload binary" if with_payload else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        name, handle = None, None
        for b in batches:
            rows = []
            for archive, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if archive != name:
                    if handle:
                        handle.close()
                    store, inner = fs.FileSystem.from_uri(archive if "://" in archive else archive.replace("file:/", "file:///", 1))
                    name, handle = archive, store.open_input_file(inner)
                rows.append(_parse(gzip.decompress(handle.read_at(n, at))) | {"archive": archive, "record_offset": at, "record_length": n})
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(schema))
        if handle:
            handle.close()

    # ranges of one archive are dealt by 4 MB stretches, in order
    near = places.select("archive", "record_offset", "record_length")
    dealt = near.repartition(F.col("archive"), F.shiftright("record_offset", 22)).sortWithinPartitions("archive", "record_offset")
    return map_arrow(dealt, run, schema)
