"""Legacy web archives (ARC) converted to WARC.

An ARC file opens with a version block that names the fields of its record lines; version 1 has five, version 2 ten.
Each record is such a line, as many bytes as its last field declares, and a line end. The converter keeps the archived
bytes and synthesises what WARC wants and ARC lacks: record ids, ISO times, record types and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.llm.common import claim_folder, open_store, stage, write_file

#: fixed values: the field lines of both ARC versions
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: fixed value of the WARC format
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CAPTURE_DATE = "20040229123456"
#: payloads below this are never replaced by a reference to an equal one
MIN_REVISIT = 1000
#: uncompressed bytes after which an archive file is closed
ARCHIVE_BYTES = 8 << 20


def arc_head(version: int, name: str, date: str = CAPTURE_DATE) -> bytes:
    block = f"{version} 0 corpus\n{FIELDS[version]}\n\n".encode()
    rest = "" if version == 1 else "200 - - 0 " + name + " "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {rest}{len(block)}\n".encode() + block


def arc_record(version: int, name: str, offset: int, url: str | None, content: bytes, date: str = CAPTURE_DATE) -> bytes:
    where = urllib.parse.quote(url or "-", safe="%/:=&?~#+!$,;'@()*[]") or "-"
    rest = "" if version == 1 else f"200 {hashlib.md5(content).hexdigest()} - {offset} {name} "
    return f"{where} 0.0.0.0 {date} text/html {rest}{len(content)}\n".encode() + content + b"\n"


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """``(offset, bytes)`` of every gzip member of a file; a file that is not packed is one piece."""
    if data and data[:2] != b"\x1f\x8b":
        yield 0, data
        return
    at, view = 0, memoryview(data)
    while at < len(data):
        unpack, parts, end = zlib.decompressobj(31), [], at
        while not unpack.eof:
            chunk = view[end : end + 16384]
            if not chunk:
                raise ValueError(f"truncated member at {at}")
            parts.append(unpack.decompress(chunk))
            end += len(chunk)
        yield at, b"".join(parts)
        at = end - len(unpack.unused_data)


def packed(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def parse_arc(chunks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, fields, content)`` of every record after the version block, by lines and declared lengths alone.

    ``chunks`` are successive pieces of the unpacked file, whose borders mean nothing: a gzip member may hold several
    records, or a part of one. ``offset`` counts unpacked bytes. Raises on a line that does not fit the version, on a
    record not followed by a line end, and on bytes left over.
    """
    names: list[str] | None = None
    held, base, closed = bytearray(), 0, True  # closed: the line end of the last record was seen
    for _, data in chunks:
        held += data
        at = 0
        while at < len(held):
            if held[at] == 10:  # the line end of a record; more of them are padding
                at, closed = at + 1, True
                continue
            if not closed:
                raise ValueError(f"no line end behind the record before {base + at}")
            line_end = held.find(b"\n", at)
            if line_end < 0:
                break
            text = held[at:line_end].decode("utf-8", "replace")
            # only the URL, the first field, could hold a space
            values = text.rsplit(" ", len(names) - 1) if names else text.split(" ")
            if (names and len(values) != len(names)) or not values[-1].isdigit() or (not names and not text.startswith("filedesc://")):
                raise ValueError(f"record line at {base + at} does not fit the version: {text[:100]}")
            end = line_end + 1 + int(values[-1])
            if end > len(held):
                break
            content = bytes(held[line_end + 1 : end])
            if names is None:
                version, _, rest = content.partition(b"\n")
                if version.split(b" ", 1)[0] not in (b"1", b"2"):
                    raise ValueError("no version block")
                names = rest.split(b"\n")[0].decode().split(" ")
            else:
                yield base + at, dict(zip(names, values)), content
            # a version block ends in its own line ends
            at, closed = end, content.endswith(b"\n") and values[0].startswith("filedesc://")
        base += at
        del held[:at]
    if held:
        raise ValueError(f"{len(held)} bytes left over at {base}, which are no whole record")


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    head, mark, body = content.partition(b"\r\n\r\n")
    return head + mark, body


def http_header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def record_id(shard: str, offset: int, url: str) -> str:
    """The same capture gets the same id on every conversion."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{shard} {offset} {url}"))


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return b"WARC/1.0\r\n" + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def converted(shard: str, offset: int, fields: dict[str, str], content: bytes, refers: str | None) -> bytes:
    """The WARC record of an ARC record; with ``refers`` a revisit without the payload."""
    date = (fields["Archive-date"] + "00000000000000")[:14]
    head, payload = http_parts(content)
    block = content if refers is None else head
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(shard, offset, fields['URL'])}>"),
        ("WARC-Date", f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z"),
        ("WARC-Target-URI", fields["URL"]),
        ("WARC-IP-Address", fields["IP-address"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", sha1_label(payload)),
        ("WARC-Block-Digest", sha1_label(block)),
    ]
    if refers is not None:
        headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:uuid:{refers}>")]
    return warc_record(headers, block)


def parse_warc(record: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if not first.startswith("WARC/") or not mark or len(rest) < length:
        raise ValueError("not a whole WARC record")
    return headers, rest[:length]


def write_arc(pages: DataFrame) -> str:
    """Archive every row of ``pages (page_id, url, html, ...)`` in ARC files of both versions; returns their folder.

    The HTTP head of a record carries the page id. A null html is an empty payload, a null url is ``-``, a null page id
    is left out; repeated rows are archived each; other columns are ignored.
    """
    folder = claim_folder(pages.sparkSession, "arc")
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")

    def run(batches):
        from pyspark import TaskContext

        part, files = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        size = 0

        def close():
            nonlocal parts, size, files
            write_file(folder, f"pages-{part:06d}-{files:04d}.arc.gz", parts)
            parts, size, files = [], 0, files + 1

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = batch.slice(start, 64).to_pydict()
                for page, url, html in zip(rows["page_id"], rows["url"], rows["html"]):
                    name, version = f"pages-{part:06d}-{files:04d}.arc", 1 + (part + files) % 2
                    if not parts:
                        parts.append(packed(arc_head(version, name)))
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    number = "" if page is None else f"X-Page-Id: {page}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {len(payload)}\r\n\r\n"
                    record = arc_record(version, name, size, url, head.encode() + payload)
                    parts.append(packed(record))
                    size += len(record)
                    if size >= ARCHIVE_BYTES:
                        close()
        if parts:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    stage(chosen.mapInArrow(run, "files long"), "arc-files")
    return folder


def _archives(spark: SparkSession, folder: str, names: str) -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.schema(schema).format("binaryFile").option("pathGlobFilter", names).load(folder)
    return files.select("path", "content")


def arc_index(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard, offset, page_id, payload_bytes, digest, record_id)`` of every ARC record."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                shard, rows = path.as_py().rsplit("/", 1)[1], []
                for offset, fields, data in parse_arc(members(content.as_py())):
                    head, payload = http_parts(data)
                    page = http_header(head, "X-Page-Id")
                    rows.append(
                        (shard, offset, None if page is None else int(page), len(payload), hashlib.sha1(payload).hexdigest(), record_id(shard, offset, fields["URL"]))
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=kinds)

    names = ["shard", "offset", "page_id", "payload_bytes", "digest", "record_id"]
    kinds = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()])))
    return _archives(spark, folder, "*.{arc,arc.gz}").mapInArrow(
        run, "shard string, offset long, page_id long, payload_bytes long, digest string, record_id string"
    )


def revisit_plan(index: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(shard, offset, refers)``: for each record the id of the record it revisits, null for a response.

    Of equal payloads of at least ``min_revisit`` bytes that with the largest page id is the response (ties: the larger
    record id; null ids are smallest).
    """
    large = index.where(F.col("payload_bytes") >= min_revisit)
    best = large.groupBy("digest", "payload_bytes").agg(
        F.count("*").alias("n"), F.max(F.struct("page_id", "record_id")).alias("best")
    )
    chosen = best.where("n > 1").select("digest", "payload_bytes", F.col("best.record_id").alias("response"))
    joined = index.join(chosen, ["digest", "payload_bytes"], "left")
    return joined.select("shard", "offset", F.expr("CASE WHEN response <> record_id THEN response END").alias("refers"))


def convert_archives(spark: SparkSession, folder: str, min_revisit: int = MIN_REVISIT) -> str:
    """Convert every ARC file of ``folder``, packed or not, to a WARC file; returns the folder of the WARC files.

    An archive that cannot be read to its end stops the conversion. A folder without archives gives an empty folder.
    """
    out = claim_folder(spark, "warc")
    index = stage(arc_index(spark, folder), "arc-index")
    files = max(1, index.select("shard").distinct().count())
    plan = revisit_plan(index, min_revisit).repartition(files, "shard").sortWithinPartitions("shard", "offset")

    def convert(shard: str, refers: dict[int, str | None]) -> None:
        store, path = open_store(f"{folder}/{shard}")
        with store.open_input_stream(path, compression=None) as stream:
            data = stream.read()
        records = (
            packed(converted(shard, offset, fields, content, refers[offset]))
            for offset, fields, content in parse_arc(members(data))
        )
        write_file(out, f"{shard.removesuffix('.arc.gz')}.warc.gz", records)

    def run(batches):
        shard, refers, done = None, {}, 0
        for batch in batches:
            for name, offset, to in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != shard:
                    if shard is not None:
                        convert(shard, refers)
                        done += 1
                    shard, refers = name, {}
                refers[offset] = to
        if shard is not None:
            convert(shard, refers)
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["files"])

    store, path = open_store(out)
    store.create_dir(path, recursive=True)
    stage(plan.mapInArrow(run, "files long"), "warc-files")
    return out


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``(record_id, page_id, url, warc_date, payload_bytes, payload_digest, record_type, refers_id)`` of every record.

    Block digests are verified, and payload digests where the payload is there.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for _, record in members(content.as_py()):
                    headers, block = parse_warc(record)
                    head, payload = http_parts(block)
                    label, kind = headers["WARC-Payload-Digest"], headers["WARC-Type"]
                    if sha1_label(block) != headers["WARC-Block-Digest"] or kind == "response" and sha1_label(payload) != label:
                        raise ValueError(f"wrong digest in {headers['WARC-Record-ID']}")
                    page = http_header(head, "X-Page-Id")
                    rows.append(
                        (
                            headers["WARC-Record-ID"][10:-1], None if page is None else int(page), headers["WARC-Target-URI"],
                            headers["WARC-Date"], int(http_header(head, "Content-Length") or 0),
                            base64.b32decode(label.removeprefix("sha1:")).hex(), kind, headers.get("WARC-Refers-To", "<urn:uuid:>")[10:-1] or None,
                        )
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=kinds)

    names = ["record_id", "page_id", "url", "warc_date", "payload_bytes", "payload_digest", "record_type", "refers_id"]
    text, number = pa.string(), pa.int64()
    kinds = pa.schema(list(zip(names, [text, number, text, text, number, text, text, text])))
    return _archives(spark, folder, "*.warc.gz").mapInArrow(
        run,
        "record_id string, page_id long, url string, warc_date string, payload_bytes long, payload_digest string, record_type string, refers_id string",
    )


def archive_digests(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` with references turned into page ids."""
    kept = stage(records, "warc-records")
    targets = kept.where("refers_id IS NOT NULL").select(F.col("refers_id").alias("record_id")).distinct()
    named = kept.join(targets, "record_id", "left_semi").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    return kept.join(named, "refers_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
