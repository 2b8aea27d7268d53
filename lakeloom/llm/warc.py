"""Web archives: WARC records, each its own Zstandard frame, with a dictionary at the head of each file.

The dictionary is trained on a bounded sample of the records to be archived. Every file begins with a
skippable frame that holds it, so each file can be read alone. Spark's text writer puts the frames on
disk: a row is some frames of about ROW_BYTES, and the line separator is an empty skippable frame, which readers
pass over. So the files go through Spark's output committer to any store it knows, lost tasks are written anew, and
no task holds more than a batch of records. A file ends after ARCHIVE_ROWS rows, so its size is bounded, and with
it what a task holds that reads it back.

Of records with equal payloads of ``DEDUP_BYTES`` or more, that with the largest page_id is a
response and the others are revisits of it. Only the digests of payloads that occur more than once
are joined to the pages; a page's payload takes part in no grouping.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, pick

DEDUP_BYTES = 1000
#: The dictionary is trained on about so many records of at most so many bytes.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 500, 32_768, 65_536, 6
#: Compressed bytes of a row of the writer, and rows of a file: one is about 64 MB, more by one record at most.
ROW_BYTES, ARCHIVE_ROWS = 1 << 20, 64
#: Records without a crawl time are dated so.
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the formats: the frame that holds a dictionary, an empty frame to be skipped, the revisit profile.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
SKIPPABLE = frozenset(bytes([0x50 + i]) + b"\x2a\x4d\x18" for i in range(16))
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:x-page:"
_CHUNK = 1 << 14


def record_id(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def page_of(value: str | None) -> int | None:
    """The page that a record id names."""
    number = value[len(_ID) + 1 : -1] if value else ""
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record if ``refers_to`` is given."""
    digest = f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"
    # a header is one line; what may not stand in a URI is percent-encoded
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]|") if url else f"{_ID}{'' if page_id is None else page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary; empty if there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, in order; its leading frame gives the dictionary."""
    at, tool = 0, zstandard.ZstdDecompressor()
    while at < len(archive):
        if archive[at : at + 4] in SKIPPABLE:
            size = int.from_bytes(archive[at + 4 : at + 8], "little")
            if at == 0 and archive[:4] == DICTIONARY_MAGIC:
                tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8 : 8 + size]))
            at += 8 + size
            continue
        one, out = tool.decompressobj(), []
        while not one.eof:
            if at >= len(archive):
                raise ValueError("the archive ends within a record")
            chunk = archive[at : at + _CHUNK]
            out.append(one.decompress(chunk))
            at += len(chunk) - len(one.unused_data)
        yield b"".join(out)


def parsed(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, HTTP head, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _sample(pages: DataFrame, n: int = SAMPLE_PAGES) -> list[bytes]:
    """About ``n`` records by hash of the page, twice as many at most, the same ones in every run."""
    step = max(1, pages.count() // n)
    order = F.xxhash64("page_id", "url")
    chosen = pages.where(F.pmod(order, F.lit(step)) == 0).where(F.octet_length("html").between(1, SAMPLE_BYTES))
    chosen = chosen.orderBy(order, "page_id", "url", "html").limit(2 * n)
    return [record(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), None) for r in sorted(chosen.collect(), key=str)]


def packed(rows: Iterator[bytes], head: bytes) -> Iterator[bytes]:
    """Frames put together to rows for the writer, which begins a file, and so a ``head``, every ARCHIVE_ROWS rows.

    A row that is larger than ROW_BYTES counts as several: empty ones follow it, of which only separators are written.
    """
    held, size, n = [], 0, 0
    for frame in rows:
        if not held and n % ARCHIVE_ROWS == 0:
            held.append(head)
        held.append(frame)
        size += len(frame)
        if size >= ROW_BYTES:
            yield b"".join(held)
            n += 1
            for _ in range(min(size // ROW_BYTES - 1, -n % ARCHIVE_ROWS)):
                yield b""
                n += 1
            held, size = [], 0
    if held:
        yield b"".join(held)


def write_archives(pages: DataFrame, folder: str, dictionary: bytes | None = None, named: bool = True) -> None:
    """Write ``pages`` (page_id, url, html, ...) as archives of bounded size in ``folder``.

    A null html is an empty payload. A row without page_id is always a response, and so is each of
    several rows with the largest page_id of a payload. An empty table makes no files. A payload of any length
    is one record, held by one task. Files are called ``*.warc.zst`` if ``named``, which renames them at the
    end; where a store copies what it renames, leave it and read the files by the writer's names.
    """
    spark = pages.sparkSession
    pages = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    held = spark.sparkContext.broadcast(dictionary_of(_sample(pages)) if dictionary is None else dictionary)
    digest = F.sha1(F.col("html").cast("binary"))
    copies = (
        pages.where(f"octet_length(html) >= {DEDUP_BYTES} and page_id is not null")
        .groupBy(digest.alias("of"))
        .agg(F.max("page_id").alias("newest"), F.min("page_id").alias("oldest"))
        .where("newest <> oldest")
        .select("of", "newest")
    )
    # what takes no part in the join is dealt by page, not all to one task
    apart = F.concat_ws(":", F.lit("page"), "page_id", "url")
    digest = F.when((F.octet_length("html") >= DEDUP_BYTES) & F.col("page_id").isNotNull(), digest).otherwise(apart)
    rows = pages.withColumn("digest", digest).join(copies, F.col("digest") == F.col("of"), "left")
    rows = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), F.when(F.col("newest") != F.col("page_id"), F.col("newest")).alias("refers_to"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = held.value
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

        def compressed() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                    yield compressor.compress(record(page_id, url, html, refers_to))

        for row in packed(compressed(), dictionary_frame(dictionary) if dictionary else b""):
            yield pd.DataFrame({"frame": [row]})

    # the writer takes strings and puts their bytes down as they are
    rows = rows.mapInPandas(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    rows.write.option("lineSep", EMPTY_FRAME.decode()).option("compression", "none").option("maxRecordsPerFile", ARCHIVE_ROWS).text(folder)
    if named:
        _named(spark, folder)


def _named(spark: SparkSession, folder: str) -> None:
    """Give the files their extension; of folders with one file for each task, only names are read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        name = status.getPath().getName()
        if re.fullmatch(r"part-.*\.txt", name):
            if status.getLen():
                store.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(path, f"{name[:-4]}.warc.zst"))
            else:
                store.delete(status.getPath(), False)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of each record.

    Size and digest are of the full payload, which revisits only name; a response whose payload doesn't
    have its digest is an error. ``payload`` is null for revisits.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for data in frames(content):
                    headers, http, payload = parsed(data)
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                    rows.append((page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], size, digest, kind, page_of(headers.get("WARC-Refers-To")), payload if kind == "response" else None))
                    if len(rows) == 256:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    schema = ", ".join(f"{n} {t}" for n, t in _COLUMNS.items())
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc.zst,txt}").load(folder)
    return files.select("content").mapInPandas(run, schema)


_COLUMNS = {"page_id": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "payload": "binary"}


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(_COLUMNS, zip(*rows, strict=True), strict=True))
    return pd.DataFrame({n: pd.array(v, "Int64") if _COLUMNS[n] == "long" else pd.Series(v, dtype="object") for n, v in columns.items()})


def archived(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of ``pages``, written to the shared folder and read back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, named=False)
    return read_archives(spark, folder).drop("url", "payload")
