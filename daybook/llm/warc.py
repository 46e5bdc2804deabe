"""Content-addressed web archives: every payload once under its SHA-256, exact record headers apart, records by a join.

``archive`` writes two tables below a path: ``payloads`` (digest, payload), each payload once, and ``headers`` (digest, record type, the exact
bytes of the WARC and HTTP headers), one row per record. ``records`` joins them on the digest, checks every payload against it, and
gives back the original records; ``export`` writes these as gzipped WARC 1.1 files, ``read`` parses such files record by record and
checks digests and lengths.

Of records with equal payloads of at least ``revisit_from`` bytes, that with the largest page id is a response and the others are
revisits of it without a payload; smaller ones are all responses. The response is chosen from digests alone. Payloads that no bitmap of
the other records excludes are stored without a shuffle, so copies of a frequent page meet only as digests, counted within tasks first.

Null payloads count as empty. Records without page id or address get headers without them; a null page id is less than all others.
Repeated rows are separate records: one response, the others revisits that refer to the same page id. An empty table gives an empty
archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import one_of_each, store, tidy

END = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2026-01-01T00:00:00Z"
RECORDS_PER_FILE = 4000


def sha256(column: str) -> Column:
    """SHA-256 as 32 bytes, half of its hexadecimal text in every shuffle."""
    return F.unhex(F.sha2(column, 256))


def base32(column: str) -> Column:
    """Base32 of a column of 40 hexadecimal digits: five of them make four letters."""
    return F.expr(
        f"array_join(transform(sequence(0, 31), i -> substring('{BASE32}', 1 + "
        f"(shiftright(cast(conv(substring({column}, cast(i div 4 as int) * 5 + 1, 5), 16, 10) as int), (3 - i % 4) * 5) & 31), 1)), '')"
    )


def line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def archive(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", revisit_from: int = 0, date: str = DATE) -> None:
    """Write the tables ``payloads`` and ``headers`` of the records of ``pages`` below ``path``."""
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"), F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload")
    )
    digest, size = sha256("payload"), F.octet_length("payload").cast("long")
    seen = rows.select("page_id", "url", digest.alias("digest"), F.unhex(F.sha1("payload")).alias("sha1"), size.alias("size"))
    counted = store(seen.groupBy("page_id", "url", "digest", "sha1", "size").count(), "warc-seen")
    groups = counted.groupBy("digest").agg(F.max("page_id").alias("keep_id"))
    joined = counted.join(groups, "digest")
    # of repeated rows of the kept id, the one with the last address comes first
    first = F.row_number().over(_window("digest", "page_id").orderBy(F.desc_nulls_last("url"))) == 1
    each = joined.withColumn("first", first).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    kept = F.col("page_id").eqNullSafe(F.col("keep_id")) & F.col("first") & (F.col("copy") == 1)
    each = each.withColumn("kept", kept).withColumn("response", F.col("kept") | (F.col("size") < revisit_from))

    record = lambda page, copy: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("|", F.lower(F.hex("digest")), F.coalesce(page.cast("string"), F.lit("")), copy)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("size").cast("string"), F.lit(END + END))
    no_copy = F.lit("kept")
    own = F.when(F.col("kept"), no_copy).otherwise(F.concat_ws("|", F.coalesce("url", F.lit("")), F.col("copy").cast("string")))
    clean_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = ~F.col("response")
    body = F.length(http) + F.when(F.col("response"), F.col("size")).otherwise(F.lit(0))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(F.col("response"), F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", record(F.col("page_id"), own)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean_url),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32("hex(sha1)"))),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", F.when(revisit, record(F.col("keep_id"), no_copy))),
        line("Page-Id", F.col("page_id")),
        line("Refers-To-Page-Id", F.when(revisit, F.col("keep_id"))),
        line("Content-Length", body),
        F.lit(END),
        http,
    )
    headers = each.select("digest", F.col("response"), header.cast("binary").alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")

    keys = {"page_id": F.col("page_id"), "digest": sha256("payload")}
    others = joined.where(~F.col("page_id").eqNullSafe(F.col("keep_id"))).select("page_id", "digest")
    twice = joined.where(F.col("page_id").eqNullSafe(F.col("keep_id"))).groupBy("page_id", "digest").agg(F.sum("count").alias("n")).where("n > 1").select("page_id", "digest")
    once = one_of_each(rows.select("page_id", "payload"), keys, others.unionAll(twice), twice)
    once = once.select(sha256("payload").alias("digest"), F.col("payload").cast("binary").alias("payload"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")


def _window(*columns: str):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The original records of an archive, as bytes without the two line ends after each; payloads are checked."""
    headers = spark.read.schema("digest binary, response boolean, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    checked = F.when(sha256("payload") == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
    full = headers.where("response").join(payloads, "digest", "left").select(F.concat("header", checked.cast("binary")).alias("record"))
    return full.unionAll(headers.where("not response").select(F.col("header").alias("record")))


def export(records_: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write records as gzipped WARC files of at most ``per_file`` records."""
    text = records_.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes, bytes]]:
    """(WARC fields, HTTP fields, header bytes, payload) of each record of an unpacked file; field names in lower case."""
    at = 0
    while at < len(raw):
        cut = raw.find(b"\r\n\r\n", at)
        if cut < 0 or not raw.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = _fields(raw[at:cut])
        begin, end = cut + 4, cut + 4 + int(fields["content-length"])
        if raw[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        http = raw.find(b"\r\n\r\n", begin, end)
        if http < 0:
            raise ValueError(f"the record at byte {at} has no HTTP headers")
        yield fields, _fields(raw[begin:http]), raw[at : http + 4], raw[http + 4 : end]
        at = end + 4


def _fields(head: bytes) -> dict[str, str]:
    pairs = (part.split(":", 1) for part in head.decode("utf-8", "surrogateescape").split("\r\n")[1:])
    return {name.lower(): value.strip() for name, value in pairs}


def gunzip(raw: bytes) -> bytes:
    out = []
    while raw:
        unpack = zlib.decompressobj(31)
        out.append(unpack.decompress(raw) + unpack.flush())
        raw = unpack.unused_data
    return b"".join(out)


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, header binary, payload binary"


def _read(batches: Iterator[pa.RecordBatch], with_content: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    number = lambda text: None if text is None else int(text)
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for fields, http, header, payload in parse(gunzip(content.as_py())):
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(http["content-length"])
                if fields["warc-type"] == "response":
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                        raise ValueError(f"record {fields['warc-record-id']} does not have the payload it states")
                rows.append((
                    number(fields.get("page-id")), fields.get("warc-target-uri"), size, digest, fields["warc-type"], number(fields.get("refers-to-page-id")),
                    header if with_content else None, payload if with_content else None,
                ))
                held += len(payload) if with_content else 100
                if held > 4 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """The records of the WARC files below ``path``, one file per task row; digests and lengths are checked."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = spark.createDataFrame([], READ).schema
    arrow = to_arrow_schema(shape)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(lambda batches: tidy(_read(batches, with_content, arrow)), shape)
