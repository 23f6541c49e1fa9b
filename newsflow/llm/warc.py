"""A content-addressed WARC archive: payloads once by digest, exact headers beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.tables import forget, keep, rest, shuffles_dropped

END = "\r\n"
DATE = "1970-01-01T00:00:00Z"  # where the time of capture is not known
REVISITED_FROM = 100  # bytes; smaller payloads are never revisited
_PAYLOADS, _RECORDS = "payloads", "records"
_NONE = (1 << 63) - 1  # in place of a missing page_id, after all others
_EXACT = "X-Exact-URI-Base64"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_archive(pages: DataFrame, path: str, least: int = REVISITED_FROM, date: str = DATE) -> None:
    """Write a WARC record per row of ``pages(page_id, url, html)`` below ``path``, captured at ``date``.

    The payload is ``html`` in UTF-8, empty if null. Of records with equal payloads
    of ``least`` bytes or more the one with the smallest ``page_id`` (null last) is
    the response, the others are revisits of it. ``payloads`` holds each payload
    once, by its SHA-256; ``records`` holds the exact header block of every record.
    Rows that agree in ``page_id``, url and payload are the same record, with one id, and read alike.
    A url with line breaks stands in its header with them escaped, and in base64 beside that.
    Other columns are not archived; an empty table gives an empty archive.

    Who holds a payload is decided on rows without payloads; then the payloads travel once.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(_NONE)).alias("at"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    with shuffles_dropped(spark):
        size, second = F.octet_length("payload").cast("long").alias("size"), F.xxhash64("payload").alias("second")
        narrow = keep(rows.select("at", "url", "digest", size, second), "headers")
        # equal digests must mean equal bytes: length and a second hash are compared before a payload is shared
        once = narrow.groupBy("digest").agg(
            F.min(F.struct("at", "url")).alias("holder"), *[f(c).alias(f"{c}_{f.__name__}") for c in ("size", "second") for f in (F.min, F.max)]
        )
        same = (F.col("size_min") == F.col("size_max")) & (F.col("second_min") == F.col("second_max"))
        unlike = F.raise_error(F.lit("payloads with one digest differ")).cast(once.schema["holder"].dataType)
        verified = once.select("digest", F.when(same, F.col("holder")).otherwise(unlike).alias("holder"))
        records = keep(narrow.join(verified, "digest"), "held")
        revisit = (F.col("size") >= least) & (F.col("at") != F.col("holder.at"))
        header = F.concat(
            F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
            F.lit(f"{END}WARC-Record-ID: "), _id(F.col("at"), F.col("url")),
            F.lit(f"{END}WARC-Date: {date}{END}WARC-Target-URI: "), F.regexp_replace("url", "[\\r\\n]", "%0A"),
            F.when(F.col("url").rlike("[\\r\\n]"), F.concat(F.lit(f"{END}{_EXACT}: "), _base64(F.col("url")))).otherwise(""),
            F.lit(f"{END}WARC-Payload-Digest: sha256:"), F.col("digest"),
            F.when(revisit, F.concat(
                F.lit(f"{END}WARC-Profile: {_PROFILE}{END}WARC-Refers-To: "), _id(F.col("holder.at"), F.col("holder.url"))
            )).otherwise(""),
            F.lit(f"{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
            F.when(revisit, 0).otherwise(F.col("size")).cast("string"),
            F.lit(END + END),
        )
        records.select(header.alias("header"), "digest").write.mode("error").parquet(f"{path}/{_RECORDS}")
        holding = F.col("at") == F.col("holder.at")
        spare = records.where(~holding).select("at", "digest").distinct()
        held = rows.select("at", "digest", "payload").join(spare, ["at", "digest"], "left_anti")
        if not records.where(holding).groupBy("digest").count().where("count > 1").isEmpty():
            held = held.dropDuplicates(["digest"])  # pages that repeat, with their payload
        held.select("digest", "payload").write.mode("error").parquet(f"{path}/{_PAYLOADS}")
        forget(narrow, records)


def _id(at: Column, url: Column) -> Column:
    page = F.when(at == _NONE, F.lit("none")).otherwise(at.cast("string"))
    return F.concat(F.lit("<urn:page:"), page, F.lit(":"), F.substring(F.sha2(url, 256), 1, 16), F.lit(">"))


def _base64(text: Column) -> Column:
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: ``header``, its full ``payload`` (a revisit's too), and the parsed fields.

    Payloads come back by a join on the digest and are hashed again; a payload that
    does not match its digest stops the job. ``block`` is what follows the header in
    the record: the payload of a response, nothing for a revisit.
    """
    records = spark.read.schema("header string, digest string").parquet(f"{path}/{_RECORDS}")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/{_PAYLOADS}")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
    sound = F.coalesce(sound, F.raise_error(F.lit("a payload does not match its digest")).cast("binary"))
    rows = records.join(payloads.withColumn("payload", sound), "digest")

    def field(name: str, pattern: str = "([^\\r\\n]*)"):
        return F.regexp_extract("header", f"\\r\\n{name}: {pattern}\\r\\n", 1)

    page, exact = "<urn:page:(-?[0-9]*)[^>]*>", field(_EXACT)
    return rows.select(
        "header",
        "payload",
        F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b"")).alias("block"),
        field("WARC-Record-ID", page).try_cast("long").alias("page_id"),
        F.when(exact != "", F.decode(F.unbase64(exact), "UTF-8")).otherwise(field("WARC-Target-URI")).alias("url"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]*)").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To", page).try_cast("long").alias("refers_to"),
    )


def records(archive: DataFrame) -> DataFrame:
    """The original bytes of each record of ``read_archive``, with the closing line breaks."""
    raw = F.concat(F.encode("header", "UTF-8"), F.col("block"), F.lit((END + END).encode()))
    return archive.select(*rest(archive), raw.alias("record"))


def export_files(archive: DataFrame, path: str) -> None:
    """Write the records as plain ``.warc`` text files, one file per task.

    The text writer's separator is the end of a WARC record.
    """
    whole = F.concat(F.col("header"), F.decode("block", "UTF-8"))
    archive.select(whole.alias("value")).write.option("lineSep", END + END).text(path)
