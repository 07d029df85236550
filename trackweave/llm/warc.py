"""WARC as a content-addressed archive.

Writing makes two tables in the shared folder: `payloads` (digest, payload), where each distinct payload
is stored once under its SHA-256, and `records` (page_id, header), the exact WARC/1.1 header bytes of
every record in their own order and spelling; `export` puts them together as WARC files.  Reading joins the two on the digest named in the header,
hashes each payload again and compares it and its length with the header, and puts the original record
(header, blank line, payload, two line ends) together again; `verified` also hashes the body of each record so made.

Scale
* Owners of a digest are found by a map-side combined minimum over (digest, id) rows, without payloads.
  Payload bytes are shuffled once when stored and once when read.
* A payload shared by a third of all pages is one stored row; its many headers are the probe side of a
  plain equi-join that adaptive execution can split, as the other side has one row per digest.

Defined cases: a null payload is empty.  Payloads shorter than `min_revisit` bytes are always responses.
If the smallest id of equal payloads occurs on several rows, all of those rows are responses.  A null id
is written as `null`, never owns a payload others refer to, and reads back as null.  Whatever some reader takes
for a line end (`ENDS`) is percent-encoded in addresses, so that no header can be broken, and reads back so.  A very
long payload is one row like any other.  An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Fixed value: the time stamped on every record, so that reruns write equal bytes.
WRITTEN_AT = "2024-01-01T00:00:00Z"
EOL = "\r\n"
#: Fixed value: the standard's name of revisits that repeat a payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Everything that some reader takes for the end of a line, and how an address spells it in a header.
ENDS = {"\n": "%0A", "\x0b": "%0B", "\x0c": "%0C", "\r": "%0D", "\x1c": "%1C", "\x1d": "%1D", "\x1e": "%1E", "\x85": "%C2%85", "\u2028": "%E2%80%A8", "\u2029": "%E2%80%A9"}


def _header(record_type: Column, page_id: Column, url: Column, digest: Column, length: Column, refers_to: Column) -> Column:
    safe = F.coalesce(url, F.lit(""))
    for char, code in ENDS.items():
        safe = F.replace(safe, F.lit(char), F.lit(code))
    ident = F.coalesce(page_id.cast("string"), F.lit("null"))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), record_type), F.concat(F.lit("WARC-Record-ID: <urn:page:"), ident, F.lit(">")), F.lit(f"WARC-Date: {WRITTEN_AT}"), F.concat(F.lit("WARC-Target-URI: "), safe), F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest), F.concat(F.lit("WARC-Payload-Length: "), length.cast("string"))]
    lines += [F.when(refers_to.isNotNull(), F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">"))), F.when(refers_to.isNotNull(), F.lit(f"WARC-Profile: {PROFILE}")), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.when(record_type == "revisit", F.lit("0")).otherwise(length.cast("string")))]
    return F.encode(F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL)), "UTF-8")  # concat_ws leaves nulls out


def write_archive(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 100) -> tuple[DataFrame, DataFrame]:
    """Writes (records, payloads) and returns them as read from the written tables."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows.select("page_id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("length"))
    owners = keyed.groupBy("digest").agg(F.min("page_id").alias("owner"))
    typed = keyed.join(owners, "digest").withColumn("record_type", F.when((F.col("length") < min_revisit) | F.col("page_id").eqNullSafe(F.col("owner")), "response").otherwise("revisit"))
    typed = typed.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("owner")))
    records = written(spark, typed.select("page_id", _header(*map(F.col, ("record_type", "page_id", "url", "digest", "length", "refers_to"))).alias("header")), "warc-records")
    # one key of owner and digest, so that rows which repeat an owner's id and payload meet in the join's task
    key = lambda ident, digest: F.concat_ws(":", digest, F.coalesce(F.col(ident).cast("string"), F.lit("null"))).alias("key")
    stored = rows.withColumn("digest", F.sha2("payload", 256)).select(key("page_id", F.col("digest")), "digest", "payload").join(owners.select(key("owner", F.col("digest"))), "key")
    payloads = written(spark, stored.groupBy("key").agg(F.first("digest").alias("digest"), F.first("payload").alias("payload")).drop("key"), "warc-payloads")
    return records, payloads


def read_archive(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row per record: its fields as parsed from the header bytes, `record` (the exact original bytes, whose body is
    left out for revisits), `payload` and `verified` (digest and length agree with the header)."""
    text = F.decode("header", "UTF-8")
    field = lambda name, value: F.regexp_extract(text, rf"\r\n{name}: {value}\r\n", 1)
    parsed = records.select(
        field("WARC-Record-ID", "<urn:page:([^>]*)>").try_cast("long").alias("page_id"), field("WARC-Type", "([a-z]*)").alias("record_type"), field("WARC-Target-URI", "([^\\r\\n]*)").alias("url"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("digest"), field("WARC-Payload-Length", "([0-9]+)").try_cast("long").alias("length"), field("WARC-Refers-To", "<urn:page:([^>]*)>").try_cast("long").alias("refers_to"), "header",
    )
    end = F.encode(F.lit(EOL + EOL), "UTF-8")
    # each stored payload is hashed and measured once, before its records are joined to it
    checked = payloads.select("digest", "payload", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    is_response = F.col("record_type") == "response"
    back = parsed.join(checked, "digest").withColumn("record", F.concat("header", F.when(is_response, F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8")), end))
    # what was put together is taken apart again: its header, its body by the length that the header states, its end
    at, n = F.octet_length("header"), F.when(is_response, F.col("length")).otherwise(F.lit(0)).cast("int")
    body = F.substring("record", at + 1, n)
    whole = (F.substring("record", F.lit(1), at) == F.col("header")) & (F.substring("record", at + n + 1, F.octet_length("record")) == end)
    return back.select(
        "page_id", "record_type", "url", "refers_to", "payload", "payload_digest", "payload_bytes", "record",
        ((F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("length")) & whole & (~is_response | (F.sha2(body, 256) == F.col("digest")))).alias("verified"),
        F.sha2("record", 256).alias("record_sha256"),
    )


def export(records: DataFrame, payloads: DataFrame, path: str) -> None:
    """Writes the records as WARC files, one per partition: a file is its records one after another."""
    end = EOL + EOL  # what ends a record is what Spark puts after each row
    record = F.col("record").cast("binary")
    body = F.substring(record, F.lit(1), F.octet_length(record) - len(end))
    read_archive(records, payloads).select(F.decode(body, "UTF-8").alias("value")).write.option("lineSep", end).text(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, payloads = write_archive(spark, table(spark, sf_dir, "pages"))
    back = read_archive(records, payloads)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified", "record_sha256")


_LINES = "'WARC/1.1\r\nWARC-Type: ' || kind || '\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\nWARC-Date: {date}\r\nWARC-Target-URI: ' || url || '\r\nWARC-Payload-Digest: sha256:' || d || '\r\nWARC-Payload-Length: ' || n || '\r\n' || case when kind = 'revisit' then 'WARC-Refers-To: <urn:page:' || owner || '>\r\nWARC-Profile: {profile}\r\n' else '' end || 'Content-Type: text/html; charset=utf-8\r\nContent-Length: ' || case when kind = 'revisit' then 0 else n end || '\r\n\r\n' || case when kind = 'revisit' then '' else html end || '\r\n\r\n'".format(date=WRITTEN_AT, profile=PROFILE).replace("\r\n", "' || chr(13) || chr(10) || '")

#: Addresses of the given tables hold no line ends, which the operator would percent-encode.
ORACLE_SQL = f"""
with p as (select page_id, coalesce(url, '') url, coalesce(html, '') html, strlen(coalesce(html, '')) n, sha256(coalesce(html, '')) d from pages),
o as (select *, min(page_id) over (partition by d) owner from p),
k as (select *, case when n < 100 or page_id = owner then 'response' else 'revisit' end kind from o)
select page_id, n::bigint payload_bytes, d payload_digest, kind record_type, case when kind = 'revisit' then owner end refers_to, true verified, sha256({_LINES}) record_sha256
from k
"""
