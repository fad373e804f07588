"""WARC (5): a content-addressed archive of web records.

``write_archive`` stores two tables in a folder: ``payloads`` holds every
distinct payload once, keyed by its SHA-256 and checked against the bytes'
length and SHA-1; ``headers`` holds each record's header bytes exactly as
they stand in a WARC 1.1 file, with the key of its payload.
``read_payloads`` verifies the stored bytes against their key,
``read_records`` parses the header bytes and joins the verified payload
facts, and ``reconstruct`` joins header and payload bytes to whole records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"       # fixed: archives of the same rows are the same bytes
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_FROM = 1000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _urn(record: Column) -> Column:
    return F.concat(F.lit("<urn:duelframe:page:"), record, F.lit(">"))


def _clean(text: Column) -> Column:
    """A header value: line ends would start another header, so they are escaped."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", "%0D"), "\n", "%0A")


def _headers() -> Column:
    """Header bytes of a record: the WARC block's length counts the HTTP header and, for a response, the payload."""
    revisit = F.col("record_type") == "revisit"
    length = F.lit(len(_HTTP)) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.coalesce(F.col("dfx_id").cast("string"), F.lit("")))),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("dfx_url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers_to").cast("string")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string"))]
    return F.encode(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n" + _HTTP)), "UTF-8")


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", revisit_from: int = REVISIT_FROM) -> None:
    """One record per row, a payload once per distinct content.

    Null payloads are empty.  Of rows with the same payload of at least
    ``revisit_from`` bytes the largest id is the response (a null id is the
    smallest; rows that repeat the largest id are responses all), the others
    are revisits of it; shorter payloads are responses all.
    """
    spark = pages.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    folder = folder.rstrip("/")
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(url_col).alias("dfx_url"), body.alias("payload"))
    facts = rows.select("dfx_id", "dfx_url", F.sha2("payload", 256).alias("key"), F.sha1("payload").alias("payload_digest"),
                        F.octet_length("payload").cast("long").alias("payload_bytes"))
    facts.write.option("compression", "zstd").parquet(f"{folder}/facts")
    facts = spark.read.schema(facts.schema).parquet(f"{folder}/facts")
    # headers: only keys and lengths move
    heads = facts.groupBy("key").agg(F.max("dfx_id").alias("head"), F.count(F.lit(1)).alias("n"))
    long_ = F.col("payload_bytes") >= revisit_from
    typed = facts.join(heads, "key").withColumn(
        "record_type", F.when(long_ & ~F.col("dfx_id").eqNullSafe(F.col("head")), "revisit").otherwise("response")
    ).withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("head")))
    (typed.select(_headers().alias("header"), "key").write.option("compression", "zstd").parquet(f"{folder}/headers"))
    # payloads: unique contents pass as they are, repeated ones meet by key, one row of each
    keyed = rows.select("payload", F.sha2("payload", 256).alias("key"))
    once = keyed.groupBy("key").agg(F.first("payload").alias("payload"))
    stored = once.select("key", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                         F.sha1("payload").alias("payload_digest"))
    stored.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored payload whose bytes still have their key; a damaged one raises."""
    p = spark.read.parquet(f"{folder.rstrip('/')}/payloads")
    right = ((F.sha2("payload", 256) == F.col("key")) & (F.octet_length("payload") == F.col("payload_bytes"))
             & (F.sha1("payload") == F.col("payload_digest")))
    return p.select("key", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    F.when(right, F.sha1("payload")).otherwise(
                        F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("key")))).alias("payload_digest"))


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("dfx_head"), rf"(?m)^{name}: ([^\r]*)", 1)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, parsed from the header bytes, with its payload's verified facts."""
    h = spark.read.parquet(f"{folder.rstrip('/')}/headers")
    h = h.withColumn("dfx_head", F.decode("header", "UTF-8"))
    number = lambda name: F.regexp_extract(_field(name), r":page:(-?\d+)>", 1)
    parsed = h.select(
        "key", F.when(number("WARC-Record-ID") != "", number("WARC-Record-ID").cast("long")).alias("page_id"),
        _field("WARC-Target-URI").alias("target_uri"), _field("WARC-Type").alias("record_type"),
        F.when(number("WARC-Refers-To") != "", number("WARC-Refers-To").cast("long")).alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "sha1:(.*)", 1).alias("header_digest"))
    facts = read_payloads(spark, folder).drop("payload")
    return parsed.join(facts, "key")


def reconstruct(spark: SparkSession, folder: str) -> DataFrame:
    """(header, record): the whole bytes of every record; a revisit's block has no payload."""
    h = spark.read.parquet(f"{folder.rstrip('/')}/headers")
    p = read_payloads(spark, folder).select("key", "payload")
    revisit = F.decode("header", "UTF-8").contains("\r\nWARC-Type: revisit\r\n")
    tail = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    return h.join(p, "key").select(
        "header", "payload", F.concat("header", F.when(revisit, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload")), tail).alias("record"))
