"""A content-addressed web archive.

Payload bytes are stored once for each SHA-256 digest, verified against it when they are read. The
exact WARC header of every record is stored apart, with the digest of its payload. Original records
come back by joining the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_hot, load

LEAST = 100  # payloads of fewer bytes are never revisits
#: A payload with more records than this is dealt, with its records, over several tasks on reading.
FAN = 2000
CRLF = "\r\n"


def _header(kind: Column) -> Column:
    """The exact header block of a record, with its closing empty line."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    url = F.coalesce("url", F.lit(""))
    # a line break in an address would end its header line
    url = F.translate(url, "\r\n", "")
    revisit = kind == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, scratch: Scratch) -> None:
    """Write pages (page_id, url, html) as the archive's two tables, payloads and headers.

    A null html is an empty payload. Of records with equal payloads of LEAST bytes or more, the one
    with the smallest page_id (null ids last; of equal ids one) is the response, the others revisit
    it; smaller payloads are all responses. Only digests are grouped; a payload moves once, and
    only that of one record for each digest.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    named = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    same = F.xxhash64("page_id", F.col("page_id").isNull(), "url", F.col("url").isNull(), "digest").alias("same")
    index = named.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes"), same)
    index = scratch.write(index.withColumn("row", F.monotonically_increasing_id()), "index")
    key = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row", "same")
    firsts = index.groupBy("digest").agg(F.min(key).alias("f"), F.count("*").alias("copies"))
    fan = F.ceil(F.col("copies") / F.lit(FAN)).cast("int").alias("fan")
    firsts = scratch.write(firsts.select("digest", F.col("f.page_id").alias("first_id"), F.col("f.row").alias("first_row"), F.col("f.same").alias("same"), fan, F.col("copies").alias("n")), "firsts")

    # narrow rows; the few digests with many records each are broadcast
    typed = join_hot(index.drop("same"), firsts.drop("same"), ["digest"], scratch, "hot")
    kind = F.when((F.col("n_bytes") >= LEAST) & (F.col("row") != F.col("first_row")), "revisit").otherwise("response")
    headers = typed.withColumn("kind", kind).select("digest", _header(F.col("kind")).alias("header"), F.pmod("row", F.col("fan")).cast("int").alias("part"))
    headers.write.option("compression", "zstd").parquet(scratch.path("headers"))
    # the digest keeps records apart whose hashes clash
    one = named.select(same, "digest", "payload").join(firsts.select("same", "digest", "fan"), ["same", "digest"])
    if not index.groupBy("same").count().where("count > 1").isEmpty():  # rows repeated with id and address
        one = one.dropDuplicates(["digest"])
    one.select("digest", "payload", "fan").write.option("compression", "zstd").parquet(scratch.path("payloads"))


def read_archive(spark: SparkSession, scratch: Scratch) -> DataFrame:
    """header, payload (the full payload, also of revisits) and its digest for every record.

    A stored payload whose SHA-256 isn't its digest raises an error.
    """
    payloads = spark.read.parquet(scratch.path("payloads"))
    right = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    payloads = payloads.withColumn("payload", F.when(right, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.hex("digest")))))
    payloads = payloads.select("digest", "payload", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("part"))
    return spark.read.parquet(scratch.path("headers")).join(payloads, ["digest", "part"]).select("header", "payload", "digest")


def record_bytes(archive: DataFrame) -> DataFrame:
    """The original WARC records: header, block and the two closing line breaks, as bytes."""
    block = F.when(F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), F.lit(b"")).otherwise(F.col("payload"))
    return archive.select(F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n")).alias("record"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", f"(?m)^{name}: ([^\\r\\n]*)", 1)


def read_records(archive: DataFrame) -> DataFrame:
    """The fields of each record, read from its header, with what its payload holds."""
    page = lambda name: F.regexp_extract(_field(name), "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    kind = _field("WARC-Type")
    return archive.select(
        page("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(kind == "revisit", page("WARC-Refers-To")).alias("refers_to"),
        _field("WARC-Target-URI").alias("url"),
        _field("Content-Length").try_cast("long").alias("content_length"),
    )


def op6_warc(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op6")
    write_archive(load(spark, sf_dir, "pages"), scratch)
    return read_records(read_archive(spark, scratch))
