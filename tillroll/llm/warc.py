"""Web archive by content: payloads once by digest, record headers apart, records by joins.

Two tables make an archive. ``payloads`` has each different payload once, by its SHA-256,
and is bucketed by it, so that records are put together again without moving payloads.
``records`` has the exact header bytes of each record and the digest of its payload. A
WARC record is header, payload and two line ends; it is made by joining the two tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_counted, rows_in, shared_folder, stored

#: Payloads of at least so many bytes are stored as revisits from the second on.
LEAST_BYTES = 0
CRLF = "\r\n"
#: The profile of a record that revisits an equal payload; digits of base 32.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    """``payloads (digest, n_bytes, first_id, copies, payload)`` and ``records (page_id,
    record_type, digest, n_bytes, copies, header)``."""

    payloads: DataFrame
    records: DataFrame
    least_bytes: int


def base32_sha1(data: Column) -> Column:
    """SHA-1 of bytes as 32 digits A-Z and 2-7: five bytes are eight digits."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def as_bytes(text: Column) -> Column:
    return F.encode(text, "utf-8")


def _header(kind: str) -> Column:
    """WARC header and HTTP header of a record, up to where its payload begins."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    length = F.octet_length(http) + (F.col("n_bytes") if kind == "response" else F.lit(0))
    lines = [
        F.lit("WARC/1.1"),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), _text("page_id"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.lit(f"Content-Type: application/http; msgtype={kind}"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    if kind == "revisit":
        lines += [
            F.lit(f"WARC-Profile: {PROFILE}"),
            F.concat(F.lit("WARC-Refers-To: <urn:page:"), _text("first_id"), F.lit(">")),
        ]
    return as_bytes(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), http))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def write_archive(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", least_bytes: int = LEAST_BYTES
) -> Archive:
    """Store one record for each row of ``pages``.

    The payload is the body in UTF-8, none for null. Of equal payloads of at least
    ``least_bytes`` the row with the smallest id is the response and the others revisit it;
    smaller ones are responses all. Null ids count as the largest; rows that repeat the
    smallest id are responses. Line ends in a url are written as spaces and null as nothing.
    An empty table gives an empty archive; other columns are left out. Rows that share a
    digest but not the length and a second hash raise: digests are verified, not trusted.
    """
    payload = as_bytes(F.coalesce(F.col(body).cast("string"), F.lit("")))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", " ").alias("uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    )
    facts = F.struct("n_bytes", F.xxhash64("payload").alias("check"))
    once = rows.groupBy("digest").agg(
        F.min(facts).alias("least"),
        F.max(facts).alias("most"),
        F.min("page_id").alias("first_id"),
        F.count(F.lit(1)).alias("copies"),
        F.first("payload").alias("payload"),
    )
    differ = F.raise_error(F.concat(F.lit("different payloads have the digest "), F.col("digest"))).cast("long")
    n_bytes = F.when(F.col("least") == F.col("most"), F.col("least.n_bytes")).otherwise(differ)
    payloads = _bucketed(once.select("digest", n_bytes.alias("n_bytes"), "first_id", "copies", "payload"))

    named = rows.select("page_id", "uri", "digest", "n_bytes", base32_sha1(F.col("payload")).alias("sha1"))
    named = stored(named, "named")
    index = payloads.select("digest", "first_id", "copies")
    headed = join_counted(named, index, "digest", "copies", rows_in(named))
    response = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.col("n_bytes") < least_bytes)
    records = headed.select(
        "page_id",
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        "digest",
        "n_bytes",
        "copies",
        F.when(response, _header("response")).otherwise(_header("revisit")).alias("header"),
    )
    return Archive(payloads, stored(records, "records"), least_bytes)


def _bucketed(once: DataFrame) -> DataFrame:
    """Write in buckets by digest to the shared folder. The table's name goes again at once;
    the files stay."""
    spark, name = once.sparkSession, f"payloads_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = once.write.bucketBy(buckets, "digest").sortBy("digest").format("parquet")
    writer.option("path", shared_folder(spark, "payloads")).saveAsTable(name)
    payloads = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return payloads


def read_archive(archive: Archive) -> DataFrame:
    """``(digest, copies, record)``: the whole bytes of every record."""
    kept = archive.records.select("digest", "copies", "n_bytes", "record_type", "header")
    stores = archive.payloads.select("digest", "payload")
    responses = kept.where("record_type = 'response'")
    # One response for each payload, but for payloads too small to be revisited: many of
    # these may share a digest, and are short.
    single = responses.where(F.col("n_bytes") >= archive.least_bytes).join(stores, "digest")
    if archive.least_bytes > 0:
        short = archive.payloads.where(F.col("n_bytes") < archive.least_bytes).select("digest", "payload", "copies")
        small = responses.where(F.col("n_bytes") < archive.least_bytes).drop("copies")
        single = single.unionByName(join_counted(small, short, "digest", "copies", rows_in(archive.records)))
    full = single.select("digest", "copies", F.concat("header", "payload", as_bytes(F.lit(CRLF * 2))).alias("record"))
    revisits = kept.where("record_type = 'revisit'")
    return full.unionByName(revisits.select("digest", "copies", F.concat("header", as_bytes(F.lit(CRLF * 2))).alias("record")))


def _field(name: str, pattern: str) -> Column:
    """Of a header line; a line ends before its carriage return."""
    return F.regexp_extract("warc", rf"(?m)^{name}: {pattern}$", 1)


def parse_records(records: DataFrame) -> DataFrame:
    """Columns from the bytes of records: ``record_id``, ``record_type``, ``refers_to``,
    ``header_digest``, ``http``, ``payload``; the payload of a revisit is null."""
    parts = F.split(F.decode("record", "utf-8"), CRLF * 2, 3)
    cut = records.select("digest", "copies", parts.alias("parts")).select(
        "digest", "copies", F.concat(F.get("parts", F.lit(0)), F.lit(CRLF)).alias("warc"), F.get("parts", F.lit(1)).alias("http"), F.get("parts", F.lit(2)).alias("rest")
    )
    kind = _field("WARC-Type", "(.*)")
    rest = F.expr(f"substring(rest, 1, length(rest) - {len(CRLF * 2)})")
    return cut.select(
        "digest",
        "copies",
        _field("WARC-Record-ID", "<urn:page:(.*)>").alias("record_id"),
        kind.alias("record_type"),
        F.when(kind == "revisit", _field("WARC-Refers-To", "<urn:page:(.*)>")).alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:(.*)").alias("header_digest"),
        "http",
        F.when(kind == "response", rest).alias("payload"),
    )


def read_pages(archive: Archive) -> DataFrame:
    """One row for each record read back: ``record_id, record_type, refers_to, payload_bytes,
    payload_digest``, the last two of the full payload, also for revisits.

    Both are computed from the bytes that were read; a digest that is not that of the header
    raises.
    """
    payload = as_bytes(F.col("payload"))
    sha1 = F.when(F.col("record_type") == "response", base32_sha1(payload))
    parsed = parse_records(read_archive(archive)).select(
        "digest",
        "copies",
        "record_id",
        "record_type",
        "refers_to",
        "header_digest",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        sha1.alias("payload_digest"),
    )
    parsed = stored(parsed, "read_back")
    responses = parsed.where("record_type = 'response'").drop("refers_to").withColumn("refers_to", F.lit(None).cast("string"))
    full = responses.groupBy("digest").agg(
        F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest"), F.min("copies").alias("copies")
    )
    full = stored(full, "full_payloads")
    revisits = parsed.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest", "copies")
    revisits = join_counted(revisits, full, "digest", "copies", rows_in(parsed))
    both = responses.unionByName(revisits)
    differ = F.raise_error(F.concat(F.lit("payload differs from its header: "), F.col("record_id"))).cast("string")
    verified = F.when(F.col("payload_digest") == F.col("header_digest"), F.col("payload_digest")).otherwise(differ)
    return both.select("record_id", "record_type", "refers_to", "payload_bytes", verified.alias("payload_digest"))
