"""WARC archives: writing, and normalising archives that are one gzip stream.

A whole-file gzip stream can only be read from its start. ``normalise`` inflates each such file once, as a stream, and
writes every record as a gzip member of its own, so that a record can be read by its offset and length alone;
``index`` is the sidecar that has them. All files are read and written by Spark, so any store that it knows will do,
and a lost task is only run again.

The text sink ends each row with a separator. Here that is the zero byte, with which a gzip member ends by itself: its
last four bytes are the length of the record, low byte first. A record of 16 MB or more ends in another byte; it is
followed by an empty member.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch, ship_package

#: Payloads from this size on are stored once.
LEAST_SHARED = 1000
#: Records of one archive as it is written.
ARCHIVE_RECORDS = 4096
#: Bytes of a normalised file, but for a larger single record: what bounds a file that is later read whole.
PART_BYTES = 64 << 20
OUT_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
CRLF = "\r\n"


def record_plan(pages: DataFrame, scratch: Scratch, least: int = LEAST_SHARED) -> DataFrame:
    """pages with payload (the html, null is empty), payload_bytes, payload_digest, record_type and refers_to. Of
    equal payloads of ``least`` bytes or more, that of the largest page_id is the response. Of rows that repeat this
    page_id, all are; null ids are never referred to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    sized = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")}
    )
    # Stored first, so that its true size decides how it is joined; only groups of two or more are in it.
    shared = scratch.store(
        sized.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1 AND kept IS NOT NULL")
        .drop("n")
    )
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return sized.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("kept")).alias("refers_to"),
    )


def _name(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def record_text(plan: DataFrame) -> DataFrame:
    """One column, ``value``: each record without its last line end. A revisit has the head of the response only."""
    uri = F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7F]", "%20")
    revisit = F.col("record_type") == "revisit"
    head = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    return plan.withColumn("block", block).select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("record_type"),
            F.lit(f"{CRLF}WARC-Record-ID: "), _name(F.col("page_id")),
            F.coalesce(F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), uri), F.lit("")),
            F.lit(f"{CRLF}WARC-Date: 2000-01-01T00:00:00Z{CRLF}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
            F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), _name(F.col("refers_to")))).otherwise(F.lit("")),
            F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("block").cast("string"),
            F.lit(CRLF * 2), F.col("block"), F.lit(CRLF),
        ).alias("value")
    )


def _unquoted(name: Column) -> Column:
    """A file's name from one with some characters as %XX; a plus sign stands for itself."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def write_archives(records: DataFrame, path: str, per_archive: int = ARCHIVE_RECORDS) -> None:
    """Records as files that are one gzip stream each."""
    records.write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def whole_records(lines: Iterable[bytes]) -> Iterator[bytes]:
    """The records of one archive from its lines (cut at each CRLF), with their closing line ends. A file that breaks
    off raises ValueError."""
    lines = iter(lines)
    for line in lines:
        if not line:
            continue
        head, length = [line], None
        for line in lines:
            head.append(line)
            if not line:
                break
            if line[:15].lower() == b"content-length:":
                length = int(line[15:])
        if length is None or not head[0].startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[0][:60]!r}")
        parts, have = [], -2
        while have < length:
            part = next(lines, None)
            if part is None:
                raise ValueError("the archive ends within a record")
            parts.append(part)
            have += len(part) + 2
        if have != length:
            raise ValueError(f"a record's block has another length than the {length} bytes it declares")
        yield b"\r\n".join([*head, *parts]) + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A record as one gzip member, always the same bytes, that ends with a zero byte."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = pack.compress(record) + pack.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def normalise(spark: SparkSession, source: str, target: str, part_bytes: int = PART_BYTES) -> None:
    """Rewrite the archives below ``source`` below ``target``, each in a folder ``archive=<its name>`` and there in folders
    ``part=<number>`` of one file of at most ``part_bytes`` (or one record). A gzip file is read by one task, from its
    start to its end, a line at a time; only one record is held, however large the archive."""
    ship_package(spark)
    lines = spark.read.option("lineSep", CRLF).text(source).select(_unquoted(F.col("_metadata.file_name")).alias("archive"), F.col("value").cast("binary"))

    def by_file(stream):
        for batch in stream:
            yield from zip(batch.column(0).to_pylist(), batch.column(1), strict=True)

    def batches(stream):
        from itertools import groupby

        def batch_of(names, parts, members):
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(parts, pa.int32()), pa.array(members, pa.binary())], names=["archive", "part", "member"]
            )

        names, parts, members, size = [], [], [], 0
        for name, rows in groupby(by_file(stream), key=lambda row: row[0]):
            part, filled = 0, 0
            for record in whole_records(value.as_py() for _, value in rows):
                data = member(record)
                if filled and filled + len(data) > part_bytes:
                    part, filled = part + 1, 0
                filled += len(data)
                names.append(name), parts.append(part), members.append(data[:-1])  # the sink adds the zero byte
                size += len(data)
                if size >= OUT_BYTES:
                    yield batch_of(names, parts, members)
                    names, parts, members, size = [], [], [], 0
        yield batch_of(names, parts, members)

    rewritten = lines.mapInArrow(batches, "archive string, part int, member binary")
    rewritten.select("archive", "part", F.col("member").cast("string").alias("value")).write.partitionBy("archive", "part").option("lineSep", "\x00").text(target)


def members_of(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each gzip member; empty members are passed over."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, out, end = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if end >= len(view):
                raise ValueError("the archive ends within a member")
            part = view[end : end + 65536]
            out.append(unpack.decompress(part))
            end += len(part)
        end -= len(unpack.unused_data)
        record = b"".join(out)
        if record:
            yield at, end - at, record
        at = end


def parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields of the record (lower-case names), head and payload of the HTTP message."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


_INDEX = [
    ("archive", "string"), ("file", "string"), ("offset", "bigint"), ("length", "bigint"), ("page_id", "bigint"), ("uri", "string"),
    ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint"),
]


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def index(spark: SparkSession, archives: str) -> DataFrame:
    """The records of normalised archives: archive, file (its path below ``archives``), offset and length of each member,
    and what the record holds. Size and digest of a response are taken from its payload, those of a revisit from what it
    says of the payload it leaves out. A file is read whole by one task; ``normalise`` bounds its size."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archives)
    place = r"(archive=([^/]+)/part=[0-9]+/[^/]*)$"
    files = files.select(_unquoted(F.regexp_extract("path", place, 2)), F.regexp_extract("path", place, 1), "content")
    arrow = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in _INDEX])

    def rows(name, file, data):
        for offset, length, record in members_of(data):
            fields, http, payload = parse(record)
            kind = fields["warc-type"]
            if kind == "revisit":
                size = int(re.search(rb"(?im)^content-length:\s*([0-9]+)", http)[1])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
            else:
                size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            yield name, file, offset, length, _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest, kind, _page(fields.get("warc-refers-to"))

    def batches(stream):
        for batch in stream:
            for name, file, data in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2), strict=True):
                found = list(rows(name, file, data.as_py()))
                columns = zip(*found, strict=True) if found else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return files.mapInArrow(batches, ", ".join(f"{n} {t}" for n, t in _INDEX))


def read_record(data: bytes, offset: int, length: int) -> bytes:
    """One record of a normalised archive by its index entry."""
    return zlib.decompress(data[offset : offset + length], 31)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them, and return the stored index of what was read
    back: one row per row of pages.

    Null html is an empty payload; a null url is left out; null ids stay null. Repeated rows are records of their own.
    Other columns are ignored, an empty table gives no records. ``folder`` (default: a fresh one in the shared folder)
    gets the normalised archives and the index.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    source, folder = scratch.path(), folder or scratch.path()
    write_archives(record_text(record_plan(pages, scratch)), source)
    normalise(spark, source, f"{folder}/archives")
    source = spark._jvm.org.apache.hadoop.fs.Path(source)
    source.getFileSystem(spark._jsc.hadoopConfiguration()).delete(source, True)
    found = index(spark, f"{folder}/archives")
    found.write.parquet(f"{folder}/index")
    return spark.read.schema(found.schema).parquet(f"{folder}/index")
