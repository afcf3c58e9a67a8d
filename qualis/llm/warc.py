"""Operator 10: WARC archives with a two-level capture index.

``write`` stores every page as a gzip member of a WARC 1.1 file in the shared
folder.  Of pages with equal payloads of at least ``MIN_REVISIT`` bytes the one
with the smallest page_id is a response, the others are revisit records that
name it.  Digests and first pages are native aggregates; only digests that
occur twice or more go into the join.  A task writes files of its own name, so
a retried or doubled task leaves an unused file at worst; what counts is the
table of captures that Spark commits.

``build_index`` sorts the captures by reversed-host URL key (``com,example)/path``)
into blocks of lines, each compressed, and keeps a sparse directory: the first
key of every block.  Blocks have ``LINES`` lines, or as many as keep the
directory under ``DIRECTORY`` entries, so the directory is bounded and may be
broadcast.  ``lookup`` binary-searches the directory for the blocks that may hold
a key, binary-searches the lines of those blocks, and returns the captures;
``fetch`` reads each capture by its byte range, ordered by file and offset.

Python tasks reach the shared folder with pyarrow's file systems (local or
mounted paths, HDFS, S3, GCS).

Defined results: null html is an empty payload; null urls are indexed under the
empty key and read back; pages that repeat a page_id and payload are all of the
type of that id; a null page_id is never referred to while an equal payload has
an id, and is a response if none has; equal keys are ordered by page_id (null
first), file and offset; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.session import cut, settings
from qualis.session import checkpoint_dir

MIN_REVISIT = 100
LINES = 3000
DIRECTORY = 65_536
ROLL = 1 << 30  # bytes of a file after which a task begins the next one
NEAR = 4 << 20  # bytes of a file that one read task takes in a row
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(folder: str):
    """(pyarrow file system, path) of a folder URI as Spark names it."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" not in folder:
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def url_key(url: str | None) -> str:
    """Reversed-host key: scheme, port 80/443 and fragment dropped, host lower-cased."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return _line(url)
    name = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return _line(f"{name}){parts.path or '/'}{'?' + parts.query if parts.query else ''}")


def _line(s: str) -> str:
    """Without characters that would break a header or index line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in s)


def record(page_id, url, payload: bytes, digest: str, refers_to, refers_url) -> bytes:
    """One WARC record, compressed as a gzip member."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Page-ID", "" if page_id is None else str(page_id)), ("Payload-Length", str(len(payload))),
            ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        body += payload
    else:
        head += [("WARC-Profile", PROFILE), ("Refers-To-Page-ID", str(refers_to))]
        if refers_url is not None:
            head.append(("WARC-Refers-To-Target-URI", _line(refers_url)))
    head.append(("Content-Length", str(len(body))))
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(WARC headers, payload) of one compressed record; checks its lengths."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    return fields, rest[:size].partition(b"\r\n\r\n")[2]


def _writer(folder: str):
    def run(batches):
        store, base = file_system(folder)
        out, name, at = None, "", 0
        for b in batches:
            raw, off = T.utf8(b.column(2))
            rows: dict[str, list] = {k: [] for k in ("key", "page_id", "file", "start", "size")}
            ids, urls, digests, refs, ref_urls = (b.column(k).to_pylist() for k in (0, 1, 3, 4, 5))
            for i in range(b.num_rows):
                if out is None or at >= ROLL:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = record(ids[i], urls[i], raw[off[i]:off[i + 1]].tobytes(), digests[i], refs[i], ref_urls[i])
                out.write(data)
                for k, v in zip(rows, (url_key(urls[i]), ids[i], name, at, len(data))):
                    rows[k].append(v)
                at += len(data)
            yield pa.RecordBatch.from_pydict(rows, schema=_CAPTURE)
        if out is not None:
            out.close()  # before the task ends and its rows are committed
    return run


_CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("start", pa.int64()),
                      ("size", pa.int64())])
_CAPTURE_SQL = "key string, page_id long, file string, start long, size long"


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``folder``; the table of captures."""
    settings(pages.sparkSession, 500)
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")) \
        .withColumn("digest", F.sha2("html", 256))
    twice = cut(rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest")
                .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"),
                     F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
                .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")))
    again = F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull())
    rows = rows.join(twice, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("refers_url"))
    return cut(rows.mapInArrow(_writer(folder), _CAPTURE_SQL))


def build_index(captures: DataFrame) -> DataFrame:
    """Captures -> cut table of index blocks (first, last, lines, data), sorted by key."""
    lines = max(LINES, -(-captures.count() // DIRECTORY))
    spark = captures.sparkSession
    order = ["key", "page_id", "file", "start"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        held: list[str] = []

        def block():
            data = zlib.compress("\n".join(held).encode(), 6)
            return pa.RecordBatch.from_pydict({"first": [held[0].split(" ", 1)[0]], "last": [held[-1].split(" ", 1)[0]],
                                               "lines": [len(held)], "data": [data]},
                                              schema=pa.schema([("first", pa.string()), ("last", pa.string()),
                                                                ("lines", pa.int64()), ("data", pa.binary())]))
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(" ".join("" if x is None else str(x) for x in row))
                if len(held) == lines:
                    yield block()
                    held.clear()
        if held:
            yield block()

    return cut(captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)
               .select(*order, "size").mapInArrow(blocks, "first string, last string, lines long, data binary"))


def directory(blocks: DataFrame) -> list[tuple[str, str]]:
    """The sparse directory: (first, last) key of every block in order, bounded by its block size."""
    return [(r["first"], r["last"]) for r in blocks.select("first", "last").distinct().orderBy("first", "last").collect()]


def lookup(blocks: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures of the URL keys in ``keys`` (key string): directory, block, line."""
    spark = blocks.sparkSession
    ranges = directory(blocks)
    shared = spark.sparkContext.broadcast(([a for a, _ in ranges], ranges))

    def route(batches):
        firsts, all_ = shared.value
        for b in batches:
            out: dict[str, list] = {"first": [], "last": [], "key": []}
            for key in b.column(0).to_pylist():
                hi = bisect_right(firsts, key) - 1
                lo = bisect_left(firsts, key)
                k = hi
                while k >= 0 and (k >= lo or all_[k][1] >= key):  # a key may run over several blocks
                    if all_[k][1] >= key:
                        out["first"].append(all_[k][0])
                        out["last"].append(all_[k][1])
                        out["key"].append(key)
                    k -= 1
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.string()) for n in out]))

    asked = cut(keys.where("key is not null").select("key").distinct().mapInArrow(route, "first string, last string, key string"))
    # keys of a block in groups of about LINES, however many keys are asked in its range
    salts = asked.groupBy("first", "last").agg(F.ceil(F.count(F.lit(1)) / LINES).alias("salts"))
    groups = asked.join(salts, ["first", "last"]) \
        .groupBy("first", "last", F.pmod(F.xxhash64("key"), F.col("salts")).alias("salt")) \
        .agg(F.collect_list("key").alias("keys"))

    def search(batches):
        for b in batches:
            out: dict[str, list] = {n: [] for n in _CAPTURE.names}
            for data, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lines = zlib.decompress(data).decode().split("\n")
                names = [x.split(" ", 1)[0] for x in lines]
                for key in wanted:
                    for k in range(bisect_left(names, key), bisect_right(names, key)):
                        _, page, name, start, size = lines[k].split(" ")
                        for n, v in zip(out, (key, int(page) if page else None, name, int(start), int(size))):
                            out[n].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_CAPTURE)

    return cut(blocks.join(groups, ["first", "last"]).select("data", "keys").mapInArrow(search, _CAPTURE_SQL))


def fetch(captures: DataFrame, folder: str) -> DataFrame:
    """Range-read the captures: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (of the stored payload for responses) and the payload (null for revisits)."""
    def run(batches):
        store, base = file_system(folder)
        name, held = "", None
        for b in batches:
            out: dict[str, list] = {n: [] for n in schema.names}
            for file, start, size in zip(*(b.column(k).to_pylist() for k in range(3))):
                if file != name:
                    if held is not None:
                        held.close()
                    name, held = file, store.open_input_file(f"{base}/{file}")
                head, payload = parse(held.read_at(size, start))
                back = head["WARC-Type"] == "revisit"
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                if not back and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {file} at {start} does not have its digest")
                refers = head.get("Refers-To-Page-ID")
                page = head["Page-ID"]
                values = (int(page) if page else None, head.get("WARC-Target-URI"), head["WARC-Type"],
                          int(refers) if refers else None, int(head["Payload-Length"]) if back else len(payload), digest,
                          None if back else payload)
                for n, v in zip(out, values):
                    out[n].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)
        if held is not None:
            held.close()

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])
    # the rows are few but stand for many bytes: a fixed number of tasks by bytes to read
    total = captures.agg(F.sum("size")).first()[0] or 0
    parts = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * NEAR)))
    near = F.floor(F.col("start") / NEAR)
    return captures.repartition(parts, "file", near).sortWithinPartitions("file", "start").select("file", "start", "size") \
        .mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                         "payload_digest string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder, index them, look every key up and read all records back."""
    folder = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    captures = write(pages, folder)
    blocks = build_index(captures)
    return fetch(lookup(blocks, captures.select("key")), folder)
