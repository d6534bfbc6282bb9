"""WARC archives with an index: a gzip member per record, read back by coalesced byte ranges.

The index comes first: writing returns a row per record with its file, offset, length, URL and payload digest, and
reading starts from rows of the index, however selected. Archives are written by the tasks that hold the pages, under
names of their own attempt, so a repeated attempt leaves the index right and at most a file nobody names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm.store import attempt_name, bounded_batches, kept, new_folder, opened

REVISIT_FROM = 1000  # payloads of fewer bytes are always written in full
FILE_BYTES = 1 << 30  # an archive is closed beyond this size
GAP, SPAN = 1 << 16, 8 << 20  # ranges closer than the gap are read as one, up to the span
LEVEL = 3
PAGE_URN = "urn:x-page:"
DATE = "1970-01-01T00:00:00Z"  # the tables don't say when a page was fetched

INDEX = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "path string, at long, n_bytes long"
)
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def _uri(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def _line(url: str) -> str:
    """A URL on one header line: control characters and line breaks are percent-encoded."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record if it refers to another page; the payload is then left out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(4, f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_uri(refers_to)}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(body: bytes) -> dict:
    """The fields of a record: page_id, record_type, refers_to, digest, payload length and (of responses) payload."""
    head, _, rest = body.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    page = lambda name: (fields[name][len(PAGE_URN) + 1 : -1] or None) if name in fields else None
    number, refers = page("WARC-Record-ID"), page("WARC-Refers-To")
    return {
        "page_id": None if number is None else int(number),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": declared,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def with_referents(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): pages and the page with the same payload they repeat, if any."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = bounded_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.filter(F.octet_length("payload") >= REVISIT_FROM)
    repeated = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("last"))
    repeated = repeated.filter("n > 1").select("digest", "last")  # not broadcast by hint: Spark goes by its size
    found = rows.join(repeated, "digest", "left")
    other = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("last")), F.col("last"))
    return found.select("page_id", "url", "payload", "digest", other.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page and return the index.

    A page is (page_id, url, html); other columns are not looked at. Null html is an empty payload, a null url leaves out
    the target. Of equal payloads of at least 1000 bytes the largest page_id has the response, rows that repeat this
    page_id too; the others revisit it. A null page_id is kept and revisits the largest id of its equals, if there is one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out, path, at = TaskContext.get().partitionId(), None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, at = attempt_name(folder, number, ".warc.gz"), 0
                    system, place = opened(path)
                    out = system.open_output_stream(place, compression=None)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                body = packer.compress(record(page_id, url, payload, digest, refers_to)) + packer.flush()
                out.write(body)
                kind = "response" if refers_to is None else "revisit"
                rows.append((page_id, url, len(payload), digest, kind, refers_to, path, at, len(body)))
                at += len(body)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], [c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()

    return kept(with_referents(pages).mapInArrow(run, INDEX), "warc-index")


def spans(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, int, int]]:
    """(path, start, end, first, last) of the reads that cover sorted (path, at, n_bytes): near ranges become one."""
    first = 0
    for i in range(1, len(places) + 1):
        path, start, _ = places[first]
        end = places[i - 1][1] + places[i - 1][2]
        if i == len(places) or places[i][0] != path or places[i][1] - end > GAP or places[i][1] + places[i][2] - start > SPAN:
            yield path, start, end, first, i
            first = i


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read(selected: DataFrame, with_payload: bool = False) -> DataFrame:
    """Fields of the records that index rows name, from the archives; a response's payload must have its digest.

    with_payload adds the payload, null for revisits. No index rows, no records.
    """
    schema = READ + ", payload binary" * with_payload
    total = selected.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(selected.sparkSession.sparkContext.defaultParallelism, -(-total // (4 * SPAN)))
    ranges = selected.select("path", "at", "n_bytes").repartitionByRange(parts, "path", "at").sortWithinPartitions("path", "at")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns)))
            if not places:
                continue
            for path, start, end, first, last in spans(places):
                system, place = opened(path)
                with system.open_input_file(place) as source:
                    body = source.read_at(end - start, start)
                rows = []
                for _, at, n in places[first:last]:
                    found = parse(zlib.decompress(body[at - start : at - start + n], 31))
                    if found["payload"] is not None:
                        if hashlib.sha1(found["payload"]).hexdigest() != found["payload_digest"]:
                            raise ValueError(f"{path} is damaged at {at}")
                    rows.append([found[c] for c in names])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return ranges.mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    return new_folder(spark, "archives")
