"""WARC archive by content: payloads stored once under a verified strong digest, exact headers apart, records put together by joins."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from larder.llm.common import PACKED_BYTES, only, slices, utf8
from larder.session import cut

VERSION, END = "WARC/1.1", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of capture, so all records have this one unless the caller gives another.
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 100_000
_BASE16, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class Archive(NamedTuple):
    """``records``: record_id, page_id, record_type, refers_to (a page_id), digest, header and http (exact bytes). ``payloads``: digest (SHA-256 of
    the payload) and packed (its bytes, compressed), one row for each distinct payload. Both are written tables."""

    records: DataFrame
    payloads: DataFrame


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hex digits: ten of them are eight digits of base 32."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _BASE16, _BASE32)


def _named(record: Column) -> Column:
    """A record id made of what identifies the record: the same input gives the same archive."""
    h = F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = DATE) -> Archive:
    """Every row of ``pages`` as a WARC record. Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest
    page_id is the response and the others revisit it; smaller ones are all responses.

    The payload is the html in UTF-8; null is empty, and an empty payload is one like any other. Ties (repeated rows, several urls of one page with one
    payload): the largest url, then one of the equal rows is the response. A null page_id is smaller than all others, and a revisit of such a response has
    a null ``refers_to``, while its header names the record. A null url is archived as ``urn:page:<page_id>``; line ends in urls are percent-encoded. An empty table gives an
    empty archive; other columns are ignored. Payloads with equal SHA-256 but different SHA-1 or size are an error.
    """
    rows = only(pages, page_id=page_id, url=url, html=html).select("page_id", "url", utf8(F.col("html")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    told = rows.select("page_id", "url", "digest", base32(F.upper(F.sha1("payload"))).alias("sha1"), F.octet_length("payload").cast("long").alias("bytes"))
    # Equal rows are one row with a count; written out, so that the records of a payload with very many copies can be split in the join.
    told = cut(told.groupBy("page_id", "url", "digest", "sha1", "bytes").agg(F.count(F.lit(1)).alias("copies")))
    same = F.struct("sha1", "bytes")
    groups = told.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"), F.min(same).alias("low"), F.max(same).alias("high"))
    checked = F.when(F.col("low") == F.col("high"), F.col("first")).otherwise(F.raise_error(F.lit("two payloads have one SHA-256 digest")))
    groups = cut(groups.select("digest", checked.alias("first")))
    each = told.join(groups, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")) & (F.col("copy") == 1)
    response = is_first | (F.col("bytes") < min_bytes)
    identity = lambda page, link, copy: _named(F.struct(page.alias("page_id"), link.alias("url"), F.hex("digest").alias("digest"), copy.alias("copy")))

    def target(page: Column, link: Column) -> Column:
        made = F.coalesce(link, F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit(""))))
        return F.replace(F.replace(made, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    named = each.select(
        identity(F.col("page_id"), F.col("url"), F.col("copy")).alias("record_id"), "page_id", "digest", "sha1", "bytes", response.alias("response"),
        identity(F.col("first.page_id"), F.col("first.url"), F.lit(1).cast("long")).alias("original"), F.col("first.page_id").alias("original_page"),
        target(F.col("page_id"), F.col("url")).alias("uri"), target(F.col("first.page_id"), F.col("first.url")).alias("original_uri"),
    )
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    bracketed = lambda value: F.concat(F.lit("<"), value, F.lit(">"))
    page_name = F.url_encode(F.col("page_id").cast("string"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        line("WARC-Record-ID", bracketed(F.col("record_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("response"), "").otherwise(F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", bracketed(F.col("original"))),
            line("WARC-Refers-To-Target-URI", F.col("original_uri")), line("WARC-Refers-To-Date", F.lit(date)),
        )),
        F.when(F.col("page_id").isNull(), "").otherwise(line("X-Page-ID", page_name)),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", (F.octet_length("http") + F.when(F.col("response"), F.col("bytes")).otherwise(0)).cast("string")),
        F.lit("\r\n"),
    )
    records = named.withColumn("http", http).select(
        "record_id", "page_id", F.when(F.col("response"), "response").otherwise("revisit").alias("record_type"),
        F.when(~F.col("response"), F.col("original_page")).alias("refers_to"), "digest", header.cast("binary").alias("header"), F.col("http").cast("binary").alias("http"),
    )
    # Packed first; the copies of a payload become one inside each task before any of them is shuffled.
    payloads = rows.select("payload").mapInArrow(_packed, "digest binary, packed binary").groupBy("digest").agg(F.first("packed").alias("packed"))
    return Archive(cut(records), cut(payloads))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for some in slices(batches, "payload"):
        data = some.column(0).to_pylist()
        digests = pa.array([hashlib.sha256(x).digest() for x in data], pa.binary())
        yield pa.RecordBatch.from_arrays([digests, pa.array([pack.compress(x) for x in data], pa.binary())], ["digest", "packed"])


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` with ``payload`` in place of ``packed``, proven to have the digest it is stored under; another one is an error."""
    kept = [c for c in rows.columns if c != "packed"]
    rows = rows.select(*kept, "packed")
    at, schema = kept.index("digest"), StructType([*[rows.schema[c] for c in kept], StructField("payload", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for some in slices(batches, "packed", max_bytes=PACKED_BYTES):
            data = [unpack.decompress(x) for x in some.column(len(kept)).to_pylist()]
            for digest, payload in zip(some.column(at).to_pylist(), data, strict=True):
                if hashlib.sha256(payload).digest() != digest:
                    raise ValueError("a stored payload does not have its digest")
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(data, pa.binary())], [*kept, "payload"])

    return rows.mapInArrow(run, schema)


def captures(stored: Archive) -> DataFrame:
    """record_id, page_id, record_type, refers_to, header, http and the full payload of every record, revisits included."""
    names = ["record_id", "page_id", "record_type", "refers_to", "header", "http", "payload"]
    return verified(stored.records.join(stored.payloads, "digest")).select(*names)


def write_files(stored: Archive, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """The archive as WARC files, compressed by gzip: of a response header, HTTP header and payload, of a revisit the headers alone."""
    responses = stored.records.filter("record_type = 'response'").select("digest", F.concat("header", "http").alias("head"))
    both = verified(responses.join(stored.payloads, "digest")).select(F.concat("head", "payload").alias("record"))
    both = both.unionByName(stored.records.filter("record_type = 'revisit'").select(F.concat("header", "http").alias("record")))
    # A record's end is what the writer puts after each line, so the files hold the records' bytes and nothing else.
    both.select(F.col("record").cast("string").alias("value")).write.option("maxRecordsPerFile", records_per_file).text(folder, compression="gzip", lineSep=END)


class _Record(NamedTuple):
    fields: dict[str, str]
    header: bytes
    block: bytes


def parse(segments: Iterator[bytes]) -> Iterator[_Record]:
    """Records from the stretches between blank lines, in their order. The length in a header decides how many stretches its block has, so
    a payload may hold blank lines and even whole records."""
    end = END.encode()
    for head in segments:
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("a WARC record does not start where the one before it ends")
        fields = {name.decode().lower(): value.strip().decode() for name, _, value in (x.partition(b":") for x in lines[1:])}
        length = int(fields["content-length"])
        parts, size = [], -len(end)
        while size < length:
            part = next(segments, None)
            if part is None:
                raise ValueError("a WARC file ends inside a record")
            parts.append(part)
            size += len(end) + len(part)
        if size != length:
            raise ValueError("a WARC record is longer than its header says")
        yield _Record(fields, head + end, end.join(parts))


def read_files(spark: SparkSession, folder: str, with_bytes: bool = True) -> DataFrame:
    """record_id, page_id (text), record_type, refers_to (a record_id), target_uri, payload_digest (bare), payload_bytes and, with ``with_bytes``, header,
    http and payload of each record of the files in ``folder``. Payload and digest of revisits are null here: ``resolved`` finds them.

    A file is compressed as a whole, hence read by one task from its start to its end; rows come in its order. A response whose payload does not have the digest in its header is an error.
    """
    rows = spark.read.text(folder, lineSep=END).select(F.col("value").cast("binary").alias("value"))
    schema = "record_id string, page_id string, record_type string, refers_to string, target_uri string, payload_digest string, payload_bytes long"
    kinds = [pa.string()] * 6 + [pa.int64()]
    if with_bytes:
        schema += ", header binary, http binary, payload binary"
        kinds += [pa.binary()] * 3
    names = [x.split()[0] for x in schema.split(", ")]

    def row(r: _Record) -> tuple:
        from urllib.parse import unquote_plus

        http, _, payload = r.block.partition(END.encode())
        page, refers = r.fields.get("x-page-id"), r.fields.get("warc-refers-to")
        out = (r.fields["warc-record-id"].strip("<>"), page and unquote_plus(page), r.fields["warc-type"], refers and refers.strip("<>"), r.fields["warc-target-uri"])
        if r.fields["warc-type"] == "response":
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if f"sha1:{digest}" != r.fields["warc-payload-digest"]:
                raise ValueError(f"the payload of {out[0]} does not have the digest in its header")
            out += (digest, len(payload))
        else:
            out += (None, None)
            payload = None
        return out + (r.header, http + END.encode(), payload) if with_bytes else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = (value.as_py() for batch in batches for value in batch.column(0))
        made: list[tuple] = []
        held = 0
        for record in parse(segments):
            made.append(row(record))
            held += len(record.block) if with_bytes else 0
            if len(made) >= 4096 or held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names)
                made, held = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)


def resolved(found: DataFrame) -> DataFrame:
    """The rows of ``read_files``, those of revisits with digest, size and payload (where read) of the response they refer to, and ``refers_to_page``. A revisit of
    a record that is not there is an error."""
    found = cut(found)
    known = [c for c in ("payload_digest", "payload_bytes", "payload") if c in found.columns]
    rest = [c for c in found.columns if c not in known]
    originals = found.filter("record_type = 'response'").select(F.col("record_id").alias("original"), F.col("page_id").alias("refers_to_page"), *known)
    revisits = found.filter("record_type = 'revisit'").select(*rest).join(originals, F.col("refers_to") == F.col("original"), "left")
    missing = F.raise_error(F.concat(F.lit("no response "), F.coalesce("refers_to", F.lit("is named"))))
    revisits = revisits.withColumn("payload_digest", F.coalesce("payload_digest", missing))
    responses = found.filter("record_type = 'response'").withColumn("refers_to_page", F.lit(None).cast("string"))
    names = [*rest, *known, "refers_to_page"]
    return responses.select(*names).unionByName(revisits.select(*names))


def written_and_read(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to (a page_id) of every row of ``pages``, read back from WARC files in ``folder``."""
    write_files(archive(pages, page_id, url, html, min_bytes), folder)
    kind = pages.schema[page_id].dataType
    found = resolved(read_files(pages.sparkSession, folder, with_bytes=False))
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").cast(kind).alias("refers_to")
    )
