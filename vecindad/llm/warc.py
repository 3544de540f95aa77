"""WARC archives with revisit records: writing, reading back and resolving them.

A crawl's pages become WARC 1.1 records.  Only headers are shuffled, by the digest of
their payload: of equal payloads the record with the least page id stays a response,
the others become revisits that refer to it and carry no payload.  Records are written
with fresh headers by Spark's text writer, whose line separator is the blank line that
ends a WARC record; so archives are committed like any other output, on any file system
Spark can write.  Files are gzip, which Spark reads as one stream.

Reading takes the lines of a file in their order as one stream of bytes and cuts it by
Content-Length, a record at a time; files of any size and foreign ``.warc.gz`` archives can be
read.  Plain archives must not be split (``spark.sql.files.maxPartitionBytes``); a part
that does not begin with a record is an error.  Revisits are joined with their responses by
record id, or by payload digest where an archive names no id.

Equal payloads have the same SHA-1, length and 64-bit hash.  Of existing archives the
payload is kept for responses alone, and other kinds of record are left out.

Defined results: a null html is an empty payload, and empty payloads are equal; a null
url has no header, white space and control characters of a url are written as %XX; a null
page id comes after all others; rows that repeat are records of their own, the first by
record id of the least page id is the response; an empty table gives no row; other
columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import stored
from vecindad.session import shared_dir

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 0
END = "\r\n"
#: What a revisit record says it is (fixed by the WARC 1.1 standard).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "X-Page-ID"
_HTTP = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "


def base32(hexadecimal: Column, digits: int = 40) -> Column:
    """Upper-case base32 of hexadecimal digits, ten (five bytes) at a time."""
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, at + 1, 10), 16, 32), 8, "0") for at in range(0, digits, 10)
    ]
    # conv writes 0-9A-V for the values 0 to 31, base32 A-Z2-7.
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """A record of each row of a stored page table: its id comes from its place there."""
    pages = spark.read.parquet(path)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    place = F.md5(F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")))
    return pages.select(
        F.concat(F.lit("urn:uuid:"), uuid_text(place)).alias("record_id"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    )


def uuid_text(hexadecimal: Column) -> Column:
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hexadecimal, at, size) for at, size in parts])


def headers(records: DataFrame) -> DataFrame:
    """All of a record but its payload: what is shuffled.  held: the payload is at hand."""
    return records.select(
        "record_id",
        "page_id",
        "url",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        payload_digest().alias("payload_digest"),
        F.xxhash64("payload").alias("payload_hash"),
        F.lit(True).alias("held"),
    )


def payload_digest() -> Column:
    return base32(F.sha1(F.col("payload").cast("binary")))


def revisits(heads: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record_id, refers_to, refers_url) of the records whose payload another one holds."""
    same = ["payload_digest", "payload_bytes", "payload_hash"]
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url")
    first = (
        heads.groupBy(*same)
        .agg(F.min(F.when(F.col("held"), order)).alias("_first"), F.count("*").alias("_records"))
        .where("_records > 1")
        .select(*same, F.col("_first.record_id").alias("refers_to"), F.col("_first.url").alias("refers_url"))
    )
    return (
        heads.join(first, same)
        .where((F.col("record_id") != F.col("refers_to")) & ((F.col("payload_bytes") >= least_bytes) | ~F.col("held")))
        .select("record_id", "refers_to", "refers_url")
    )


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def safe_uri(url: Column) -> Column:
    """The URI without white space and control characters, which would end its header."""
    codes = [*range(0x21), 0x7F]
    out = url
    escaped = F.transform(
        F.split(out, ""),
        lambda c: F.when(F.ascii(c).isin(codes) & (F.octet_length(c) == 1), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c),
    )
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), F.array_join(escaped, "")).otherwise(url)


def record_text(date: str) -> Column:
    """The record of a row with record_id, page_id, url, payload and its digest, and refers_to or null."""
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload").cast("string")
    head = F.concat(F.lit(_HTTP), size, F.lit(END + END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(head, F.col("payload")))
    length = F.when(revisit, F.lit(0)).otherwise(F.octet_length(head) + F.octet_length("payload"))
    angle = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", angle(F.col("record_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", safe_uri(F.col("url"))),
        _line(PAGE, F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, angle(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, safe_uri(F.col("refers_url")))),
        _line("Content-Type", F.when(~revisit, F.lit("application/http;msgtype=response"))),
        _line("Content-Length", length),
        F.lit(END),
        block,
    )


def write(
    records: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    least_bytes: int = LEAST_BYTES,
    pointers: DataFrame | None = None,
) -> None:
    """Archives of the records (record_id, page_id, url, payload) under ``path``; equal payloads are written once.

    ``pointers``: headers of records whose payload some record has; they are revisits.
    """
    heads = headers(records)
    rows = records.select("record_id", "page_id", "url", "payload", payload_digest().alias("payload_digest"))
    if pointers is not None:
        heads = heads.unionByName(pointers)
        rows = rows.unionByName(pointers.select("record_id", "page_id", "url", "payload_digest"), allowMissingColumns=True)
    repeats = stored(revisits(heads, least_bytes))
    lines = rows.join(repeats, "record_id", "left").select(record_text(date).alias("value"))
    lines.write.option("lineSep", END + END).option("compression", "gzip").text(path)


READ = (
    "record_type string, record_id string, page_id long, url string, payload_digest string, refers_to string, "
    "payload_bytes long, payload binary"
)
_NAMES = [c.split()[0] for c in READ.split(", ")]


class Stream:
    """Bytes of one file as they come; gives whole records and keeps the rest."""

    def __init__(self):
        self._parts: list[bytes] = []
        self._held, self._need = 0, 1
        self._data, self._at = b"", 0

    def add(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self._parts.append(data)
        self._held += len(data)
        if self._held < self._need:
            return
        self._data = b"".join([self._data[self._at :], *self._parts])
        self._parts, self._at = [], 0
        while (found := self._record()) is not None:
            yield found
        self._held = len(self._data) - self._at

    def _record(self) -> tuple[dict[str, str], bytes] | None:
        data = self._data
        while data.startswith(b"\n", self._at) or data.startswith(b"\r\n", self._at):
            self._at = data.index(b"\n", self._at) + 1
        if self._at < len(data) and not data.startswith(b"WARC/"[: len(data) - self._at], self._at):
            raise ValueError("no WARC record where one has to begin; was a plain archive split?")
        stop = data.find(b"\r\n\r\n", self._at)
        if stop < 0:
            self._need = 1
            return None
        head: dict[str, str] = {}
        name = ""
        for line in data[self._at : stop].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t"):  # a folded line
                head[name] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            name = name.strip().lower()
            head[name] = value.strip()
        end = stop + 4 + int(head["content-length"])
        if len(data) < end:
            self._need = end - self._at
            return None
        self._at, self._need = end, 1
        return head, data[stop + 4 : end]

    def close(self) -> None:
        if b"".join([self._data[self._at :], *self._parts]).strip():
            raise ValueError("an archive ends within a record")


def payload_of(head: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP header that an application/http block begins with."""
    if head.get("content-type", "").replace(" ", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _row(head: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = head.get("warc-type")
    payload = payload_of(head, block)
    digest = (head.get("warc-payload-digest") or "").partition(":")[2] or None
    size = None
    if kind != "revisit":
        # Counted and digested anew from what is really there.
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    page = head.get(PAGE.lower())
    return (
        kind,
        _bare(head.get("warc-record-id")),
        int(page) if page else None,
        head.get("warc-target-uri"),
        digest,
        _bare(head.get("warc-refers-to")),
        size,
        payload if payloads and kind != "revisit" else None,
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records under ``path`` in the columns of READ; a revisit has no payload of its own."""
    lines = spark.read.option("lineSep", "\n").text(path)
    data = lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.concat("value", F.lit("\n")).cast("binary").alias("data"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, stream = None, Stream()

        def rows(found) -> Iterator[pa.RecordBatch]:
            taken, held = [], 0
            for head, block in found:
                taken.append(_row(head, block, payloads))
                held += len(block) if payloads else 1000
                if held > 4_000_000:
                    yield _batch(taken)
                    taken, held = [], 0
            if taken:
                yield _batch(taken)

        for batch in batches:
            files = batch.column(0).to_numpy()
            cuts = [0, *((files[1:] != files[:-1]).nonzero()[0] + 1).tolist(), len(files)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if files[a] != file:
                    stream.close()
                    file, stream = files[a], Stream()
                part = batch.column(1).slice(a, b - a)
                offsets = memoryview(part.buffers()[1]).cast("i")
                first, last = offsets[part.offset], offsets[part.offset + len(part)]
                yield from rows(stream.add(part.buffers()[2].slice(first, last - first).to_pybytes()))
        stream.close()

    return data.mapInArrow(run, READ)


_KINDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), _KINDS.get(n, pa.string())) for n, c in zip(_NAMES, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def resolved(records: DataFrame) -> DataFrame:
    """Response and revisit records, each revisit with the response it repeats.

    A revisit is joined by the record id it refers to, one without by its payload
    digest; one whose response is not there keeps nulls.
    """
    known = records.where("record_type = 'response'").select(
        "record_id", "page_id", "payload_digest", "payload_bytes", "url", "record_type"
    )
    answers = known.select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes")
    )
    again = records.where("record_type = 'revisit'").select("record_id", "page_id", "payload_digest", "url", "record_type", "refers_to")
    named = again.where("refers_to is not null").join(
        answers.withColumnRenamed("_id", "refers_to"), "refers_to", "left"
    )
    by_digest = known.groupBy(F.col("payload_digest")).agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "payload_bytes")).alias("_first")
    )
    unnamed = again.where("refers_to is null").join(by_digest, "payload_digest", "left").select(
        F.col("_first.record_id").alias("refers_to"),
        *[c for c in again.columns if c != "refers_to"],
        F.col("_first.page_id").alias("_page"),
        F.col("_first.payload_bytes").alias("_bytes"),
    )
    columns = ["record_id", "page_id", "url", "payload_bytes", "payload_digest", "record_type"]
    revisit = named.unionByName(unnamed.select(*named.columns)).withColumnRenamed("_bytes", "payload_bytes")
    return known.select(*columns, F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_record")).unionByName(
        revisit.select(*columns, F.col("_page").alias("refers_to"), F.col("refers_to").alias("refers_record"))
    )


def rewrite(spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES) -> None:
    """Deduplicated archives from existing ones: responses anew, revisits against the responses that stay.

    Payloads that are no UTF-8 cannot be written by Spark's text writer and are an error.
    """
    records = stored(read_archives(spark, source))
    whole = records.where("record_type = 'response'").select(
        "record_id", "page_id", "url", F.expr("decode(payload, 'UTF-8')").alias("payload")
    )
    # A revisit of the source has the payload of its response: headers are all that is joined.
    known = headers(whole).select(F.col("record_id").alias("refers_record"), "payload_bytes", "payload_digest", "payload_hash")
    again = resolved(records).where("record_type = 'revisit'").select("record_id", "page_id", "url", "refers_record")
    pointers = again.join(known, "refers_record").drop("refers_record").withColumn("held", F.lit(False))
    write(whole, target, least_bytes=least_bytes, pointers=stored(pointers))


def op12_archives(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/vecindad-warc-{uuid.uuid4().hex}"
    write(page_records(spark, f"{folder}/pages.parquet"), path)
    records = stored(read_archives(spark, path, payloads=False).drop("payload"))
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
