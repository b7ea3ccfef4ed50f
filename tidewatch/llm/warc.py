"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME_BYTES``, each an independent
Zstandard frame; a bundle is a sequence of frames closed by a footer seek
table (a skippable frame in the public seekable format: compressed and
decompressed size per frame).  The index maps every record to its bundle,
its frame and its offset inside the decompressed frame, so one record costs
one ranged read of one frame.

Payloads that occur again are stored once: of records with equal payloads of
at least ``MIN_REVISIT`` bytes, the one with the largest ``page_id`` is a
``response`` and the others are ``revisit`` records that refer to it.

Tasks write bundles straight to the target folder (any URI that
``pyarrow.fs`` opens).  A bundle's name is new for every task attempt and only
the index, a table that Spark commits, names the valid ones, so retried and
speculative tasks leave at most unnamed files behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table, written
from tidewatch.session import scratch_path

FRAME_BYTES, BUNDLE_BYTES, MIN_REVISIT, LEVEL, ROWS = 1 << 20, 64 << 20, 1000, 3, 256
#: Frames that one task reads back, and the most tasks per shuffle partition.
FRAMES_PER_TASK, MOST_PER_PARTITION = 64, 16
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the public formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id long, record_id string, bundle string, frame int, frame_at long, "
         "frame_bytes long, record_at long, record_bytes long")
RECORDS = ("page_id long, record_id string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to_record string")


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI."""
    uri = re.sub(r"^file:/+", "file:///", uri).replace("s3a://", "s3://", 1)
    if "://" not in uri:
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{page_id}:{digest}").urn


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, date: str = DATE) -> tuple[str, bytes]:
    """Identifier and bytes of one WARC record; a revisit holds no payload."""
    revisit = refers_to is not None
    ident = record_id(page_id, digest, "revisit" if revisit else "response")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{ident}>", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:  # white space and control characters would end the header
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    head.append(f"WARC-Payload-Digest: sha1:{coded}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}",
                 f"WARC-Refers-To: <{record_id(refers_to, digest, 'response')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ident, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines)
    start, size = end + 4, int(head["Content-Length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return head, data[start:start + size], start + size + 4


class BundleWriter:
    """Collects records into frames and frames into bundle files."""

    def __init__(self, target: str, frame_bytes: int = FRAME_BYTES,
                 bundle_bytes: int = BUNDLE_BYTES):
        import zstandard
        self._fs, self._path = filesystem(target)
        self._pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self._frame_bytes, self._bundle_bytes = frame_bytes, bundle_bytes
        self._out = None
        self._held, self._size = [], 0

    def add(self, page_id: int | None, ident: str, data: bytes) -> list[tuple]:
        """Index rows of the records that this one completes a frame for."""
        self._held.append((page_id, ident, data))
        self._size += len(data)
        return self._flush() if self._size >= self._frame_bytes else []

    def _flush(self) -> list[tuple]:
        if not self._held:
            return []
        if self._out is None:
            self._name = f"{uuid.uuid4().hex}.warc.zst"
            self._out = self._fs.open_output_stream(f"{self._path}/{self._name}", compression=None)
            self._frames, self._at, self._raw = [], 0, 0
        packed = self._pack(b"".join(x[2] for x in self._held))
        self._out.write(packed)
        rows, within = [], 0
        for page_id, ident, data in self._held:
            rows.append((page_id, ident, self._name, len(self._frames), self._at, len(packed),
                         within, len(data)))
            within += len(data)
        self._frames.append((len(packed), within))
        self._at += len(packed)
        self._raw += within
        self._held, self._size = [], 0
        if self._raw >= self._bundle_bytes:
            self._close_bundle()
        return rows

    def _close_bundle(self) -> None:
        table_ = b"".join(struct.pack("<II", *f) for f in self._frames)
        table_ += struct.pack("<IBI", len(self._frames), 0, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table_)) + table_)
        self._out.close()
        self._out = None

    def close(self) -> list[tuple]:
        rows = self._flush()
        if self._out is not None:
            self._close_bundle()
        return rows


class BundleReader:
    """Frames of one bundle, found through its seek table."""

    def __init__(self, target: str, bundle: str):
        import zstandard
        fs, path = filesystem(target)
        self._file = fs.open_input_file(f"{path}/{bundle}")
        self._unpack = zstandard.ZstdDecompressor().decompress
        size = self._file.size()
        frames, _, magic = struct.unpack("<IBI", self._file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{bundle} has no seek table")
        raw = self._file.read_at(8 * frames, size - 9 - 8 * frames)
        self.frames, at = [], 0  # (offset, compressed size)
        for packed, _ in struct.iter_unpack("<II", raw):
            self.frames.append((at, packed))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed = self.frames[number]
        return self._unpack(self._file.read_at(packed, at))

    def close(self) -> None:
        self._file.close()


def read_record(target: str, entry) -> tuple[dict[str, str], bytes]:
    """Headers and block of one indexed record: one ranged read of its frame."""
    reader = BundleReader(target, entry["bundle"])
    try:
        return parse(reader.frame(entry["frame"]), entry["record_at"])[:2]
    finally:
        reader.close()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
        names=[n for n, _ in fields])


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` and ``refers_to`` (null for responses)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    # equal payloads: equal SHA-1, XXH64 and length
    key = [F.sha1("html").alias("digest"), F.xxhash64("html").alias("_x"),
           F.octet_length("html").alias("_n")]
    again = written(
        rows.filter(F.octet_length("html") >= min_bytes).select("page_id", *key)
        .groupBy("digest", "_x", "_n").agg(F.max("page_id").alias("last"),
                                           F.count("*").alias("n"))
        .filter("n > 1").drop("n"), "warc-repeated")
    return rows.select("*", *key).join(again, ["digest", "_x", "_n"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archive(pages: DataFrame, target: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` under ``target``; returns the index."""
    fs, path = filesystem(target)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = BundleWriter(target, frame_bytes, bundle_bytes)
        for b in slices(batches, ROWS):
            rows = []
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                ident, data = record(page_id, url, html.encode(), digest, refers_to)
                rows += out.add(page_id, ident, data)
            if rows:
                yield _batch(rows, INDEX)
        if rows := out.close():
            yield _batch(rows, INDEX)

    return written(with_revisits(pages).mapInArrow(run, INDEX), "warc-index")


def read_archive(index: DataFrame, target: str) -> DataFrame:
    """Records of all indexed bundles; length and digest of a response are taken
    from its payload, those of a revisit are left to the response it refers to."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for b in batches:
            for bundle, number in zip(*(c.to_pylist() for c in b.columns)):
                if bundle != opened:  # frames of a bundle come one after the other
                    if reader:
                        reader.close()
                    reader, opened = BundleReader(target, bundle), bundle
                data, at, rows = reader.frame(number), 0, []
                while at < len(data):
                    head, block, at = parse(data, at)
                    page = head.get("X-Page-ID")
                    row = [None if page is None else int(page),
                           head["WARC-Record-ID"][1:-1], head["WARC-Type"]]
                    stated = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
                    if row[2] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        digest = hashlib.sha1(payload).hexdigest()
                        if digest != stated:
                            raise ValueError(f"payload of {row[1]} differs from its digest")
                        rows.append((*row, len(payload), digest, None))
                    else:
                        rows.append((*row, None, stated, head["WARC-Refers-To"][1:-1]))
                yield _batch(rows, RECORDS)
        if reader:
            reader.close()

    # a row for each frame, not for each bundle, and a stated number of ranges: rows so
    # small would be merged into one task, which then read the whole archive
    frames = index.select("bundle", "frame").distinct()
    spread = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(MOST_PER_PARTITION * spread, max(spread, -(-frames.count() // FRAMES_PER_TASK)))
    return (frames.repartitionByRange(tasks, "bundle", "frame")
            .sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORDS))


def archived(pages: DataFrame, target: str | None = None) -> DataFrame:
    """Write ``pages`` to an archive, read it back: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` per row.

    * null html is an empty payload; payloads under ``MIN_REVISIT`` bytes are
      all responses;
    * of equal payloads every row with the largest ``page_id`` is a response
      (more than one only if rows repeat it); a row without ``page_id``
      revisits it like any other, and is a response if no row has an id;
    * a null URL leaves the target header out; other columns are not read; an
      empty table gives no rows.
    """
    target = target or scratch_path(pages.sparkSession, "warc")
    records = written(read_archive(write_archive(pages, target), target), "warc-records")
    whole = records.filter("record_type = 'response'")
    base = written(
        whole.join(records.select(F.col("refers_to_record").alias("record_id"))
                   .filter("record_id is not null").distinct(), "record_id", "left_semi")
        .select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
                F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
        .distinct(), "warc-referred")
    revisits = records.filter("record_type = 'revisit'").join(base, "refers_to_record", "left")
    same = F.col("payload_digest") == F.col("_digest")
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type",
                        F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("_bytes").alias("payload_bytes"),
                        F.when(same, F.col("payload_digest")).otherwise(F.raise_error(
                            F.lit("a revisit refers to no record with its payload")))
                        .alias("payload_digest"), "record_type", "refers_to"))


def op2_warc(spark, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     m AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
                  max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m"""
