"""WARC archives, index first.

Every task writes its records, each a gzip member of its own, to a new archive and returns an index
row per record: archive, offset, length, URL and digest. Only the index of the attempt that succeeded
is kept, so an archive of a lost attempt is never read. Reading takes rows of the index, sorts them by
place, and joins ranges that lie close together into one read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, table

DATE = "2000-01-01T00:00:00Z"
ARCHIVE_BYTES = 1 << 30
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Bytes of an archive that one task reads in a row, and of all archives for each task.
STRETCH_BYTES = 16 << 20
MIN_REVISIT_BYTES = 0
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, digest string, archive string, offset long, length long"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(path)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> tuple[str, bytes]:
    """Digest and bytes of one record; a revisit, if it refers to another page."""
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return digest, squeeze.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parse_record(member: bytes) -> dict:
    """What a record says; a response's payload is held against its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", x or "")) else None
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError("a payload differs from its digest")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload, "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To"))}


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) and returns the written index.

    A null html is an empty payload. Of equal payloads of at least min_revisit_bytes the one with the
    largest page_id is the response (rows alike in id and payload all are), the others revisit it; a
    group of null ids only is all responses. Digests are counted before they are shuffled, and the
    payloads are then dealt by page and digest, so copies of one page spread over all tasks.
    """
    d = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    d = d.withColumn("sha1", F.sha1("payload"))
    long_ = F.when(F.octet_length("payload") >= min_revisit_bytes, F.col("sha1"))
    ids = d.select("page_id", long_.alias("sha1")).where("sha1 is not null")
    last = table(ids.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-last")
    refers = ids.join(last, "sha1").where("page_id is null or page_id <> last").where("last is not null")
    refers = table(refers.select("page_id", "sha1", F.col("last").alias("refers_to")).distinct(), "warc-refers")
    same = d["page_id"].eqNullSafe(refers["page_id"]) & (d["sha1"] == refers["sha1"])
    dealt = d.join(refers, same, "left").select(d["page_id"], d["url"], d["payload"], refers["refers_to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, refers_to in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    digest, member = record(page_id, url, payload, refers_to)
                    out.write(member)
                    rows.append((page_id, url, digest, f"{folder}/{name}", at, len(member)))
                    at += len(member)
                types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["page_id", "url", "digest", "archive", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return table(dealt.mapInArrow(run, INDEX), "warc-index")


def ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Reads (archive, from, to, places) that cover sorted (archive, offset, length) places."""
    own: list[int] = []
    name, start, end = "", 0, 0
    for i, (archive, offset, length) in enumerate(places):
        if own and (archive != name or offset - end > GAP_BYTES or offset + length - start > READ_BYTES):
            yield name, start, end, own
            own = []
        if not own:
            name, start, end = archive, offset, offset + length
        own.append(i)
        end = max(end, offset + length)
    if own:
        yield name, start, end, own


def read_records(index: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the given rows of an index, with their payload if asked for.

    Rows of the index are few bytes, whatever they point to, so stretches of the archives are dealt to
    as many tasks as their bytes ask for.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(total // STRETCH_BYTES + 1, min(index.sparkSession.sparkContext.defaultParallelism, total // GAP_BYTES + 1))
    d = index.select("archive", "offset", "length").repartition(tasks, "archive", F.floor(F.col("offset") / min(STRETCH_BYTES, total // tasks + 1)))
    d = d.sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * payloads
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.binary()] * payloads
        file, opened = None, ""
        for b in batches:
            places = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            for archive, start, end, own in ranges(places):
                if archive != opened:
                    if file is not None:
                        file.close()
                    fs, path = _open(archive)
                    file, opened = fs.open_input_file(path), archive
                data = file.read_at(end - start, start)
                got = [parse_record(data[places[i][1] - start :][: places[i][2]]) for i in own]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in got], t) for n, t in zip(names, types)], names)
        if file is not None:
            file.close()

    return d.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payloads)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archives all pages in the shared folder and reads every record back."""
    folder = f"{shared_dir(pages.sparkSession)}/tidemark/warc-{uuid.uuid4().hex}"
    return read_records(write_archives(pages, folder))
