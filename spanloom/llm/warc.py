"""A content-addressed web archive: payload bytes once, by verified digest; exact record headers beside them.

``write_archive`` leaves two Parquet tables: ``payloads`` (address = SHA-256 of the bytes, bytes), dealt to buckets by
address, and ``headers`` (one row per record: its page_id, exact url, kind and what it refers to, its WARC header and HTTP
header text, and its payload's address). The first record of a payload (least page_id) is a response; later ones are
revisits that refer to it. ``read_records`` joins the two, checks every payload against its address, puts each record
together as it stands in a .warc file, and checks it against its own header. ``read_archive`` tells what those records
are.

Payload bytes are shuffled once, one copy per task at most, when they are stored. On reading, headers go to the
payloads' buckets; records of a hot payload are dealt to several copies of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import HOT_KEYS, HOT_ROWS, discard, join_unique, materialize, scratch_root

BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 10 hex digits are 8 base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), BASE32_HEX, BASE32)


def record_id(page_id: Column) -> Column:
    """A urn:uuid made from the page's id, the same on every run."""
    d = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    cuts = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def header_text(url: Column) -> Column:
    """A url as header text: control characters, which would end the line, percent-encoded."""
    out = url
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), out).otherwise(url)


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to the archive at ``path``.

    Payloads are the html in UTF-8; a null html is the empty payload, a null url an empty one. Of records with equal
    payloads of ``min_bytes`` bytes or more, those with the least page_id are responses and the others revisits;
    shorter payloads are always responses. Repeated rows with the least page_id are all responses. Pages without an
    id come before all others. A url is kept exactly in its own column, and with control characters percent-encoded
    in the header. Other columns are ignored; an empty table gives an empty archive.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).withColumn("address", F.sha2("payload", 256))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = rows.groupBy("address").agg(F.first("payload").alias("payload"))
    name = f"archive_{uuid.uuid4().hex}"
    stored.write.bucketBy(buckets, "address").option("path", f"{path}/payloads").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/layout")
    narrow = rows.select("page_id", "url", "address", F.octet_length("payload").cast("long").alias("size"), sha1_base32(F.col("payload")).alias("digest"))
    first = materialize(narrow.groupBy("address").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")), "first-records")
    records = join_unique(narrow, first, ["address"], "n")
    again = ~F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("size") >= min_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    records = records.select("*", F.when(again, "revisit").otherwise("response").alias("kind"), http.alias("http_header"))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "kind"),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), header_text(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.concat(F.lit("Page-ID: "), F.col("page_id").cast("string")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("first.page_id")), F.lit("\r\nWARC-Refers-To-Target-URI: "), header_text(F.col("first.url")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length("http_header") + F.when(again, 0).otherwise(F.col("size"))).cast("string")),
    ]
    warc = F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"))  # concat_ws leaves out what is null
    records.select("address", "page_id", "url", "kind", F.when(again, F.col("first.page_id")).alias("refers_to"), F.when(again, F.col("first.url")).alias("refers_to_url"), warc.alias("warc_header"), "http_header").write.parquet(f"{path}/headers")
    discard(first)


def stored_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads in their buckets, each checked: bytes that don't match their address end the job."""
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    name = f"archive_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (address STRING, payload BINARY) USING parquet CLUSTERED BY (address) INTO {buckets} BUCKETS LOCATION '{path}/payloads'")
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external again: only the name goes
    sound = F.sha2("payload", 256) == F.col("address")
    return stored.withColumn("payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its address "), "address"))))


def with_payloads(headers: DataFrame, stored: DataFrame) -> DataFrame:
    """Each header row with its payload. Rows of a hot payload are dealt to copies of it, one for each HOT_ROWS of them."""
    counts = materialize(headers.groupBy("address").agg(F.count("*").alias("n")), "payload-uses")
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    least = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= least:
        return headers.join(stored, "address", "left")
    hot = F.broadcast(counts.where(F.col("n") > least).select("address", F.ceil(F.col("n") / least).cast("int").alias("copies")))  # HOT_KEYS rows at most
    cold = headers.join(hot, "address", "left_anti").join(stored, "address", "left")
    dealt = headers.join(hot, "address").withColumn("copy", F.pmod(F.xxhash64("page_id", "url"), F.col("copies")).cast("int")).drop("copies")
    copied = stored.join(hot, "address").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return cold.unionByName(dealt.join(copied, ["address", "copy"], "left").drop("copy"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, refers_to_url, payload, and record, its bytes as they
    stand in a .warc file (headers, block and the closing blank lines).

    Headers without a stored payload, and records whose block or digest differs from what their header says, end the job.
    """
    records = with_payloads(spark.read.parquet(f"{path}/headers"), stored_payloads(spark, path))
    response = F.col("kind") == "response"
    body = F.when(response, F.col("payload")).otherwise(F.lit(b""))
    declared = lambda field: F.regexp_extract("warc_header", rf"\r\n{field}([^\r\n]*)\r\n", 1)
    sized = declared("Content-Length: ") == (F.octet_length("http_header") + F.octet_length(body)).cast("string")
    sound = sized & (declared("WARC-Payload-Digest: sha1:") == sha1_base32(F.col("payload")))
    whole = F.concat(F.encode("warc_header", "UTF-8"), F.encode("http_header", "UTF-8"), body, F.lit(b"\r\n\r\n"))
    checked = F.when(sound, whole).otherwise(F.raise_error(F.concat(F.lit("no sound payload at "), "address")))
    return records.select("page_id", "url", F.col("kind").alias("record_type"), "refers_to", "refers_to_url", "payload", checked.alias("record"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, of the records put together: page_id, payload_bytes, payload_digest, record_type, refers_to,
    and record_sha256. Bytes and digest are those of the full payload, of revisits too.
    """
    rows = read_records(spark, path)
    return rows.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest"), "record_type", "refers_to", F.sha2("record", 256).alias("record_sha256"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/spanloom-archive-{uuid.uuid4().hex}"
    write_archive(pages, path)
    return read_archive(spark, path)
