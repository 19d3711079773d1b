"""WARC archives: write pages with revisit records, read them back by boundary chains.

Archives are plain text sinks and sources to Spark, cut at the bytes that part two
records.  The same bytes inside a payload cut there too, so a cut is only a
candidate: it names the offset at which its record would end.  Following these
successors from the start of the file reaches the true records and no others.
Unbroken stretches of the chain are contracted first, then pointers jump in
doubling steps.  Cuts inside a payload are put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.session import work_path
from vectrail.sources.tables import write_table

GAP = "\r\n\r\n"
MAGIC = "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32 (RFC 4648), without a label."""
    hexed = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_warc(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    records_per_file: int = 200_000,
    compression: str = "none",
) -> None:
    """One record per row: ``response`` with the payload, or ``revisit`` without it.

    Of rows with equal payloads (by SHA-1 and length) of at least ``min_bytes``, those
    with the largest id are responses and the others revisits that refer to it; smaller
    payloads are all responses.  The payload is a text in UTF-8 or binary; NULL is empty.
    A NULL id is below all others and written as an empty name; line breaks in a URL are
    percent-encoded.  Repeated rows give repeated records; extra columns are not written.
    """
    spark = pages.sparkSession
    page = pages.select(
        F.col(id_column).alias("_page"),
        F.col(url_column).alias("_url"),
        F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")).alias("_payload"),
    ).withColumns({"_digest": base32_sha1(F.col("_payload")), "_bytes": F.octet_length("_payload").cast("long")})
    light = write_table(page.select("_page", "_digest", "_bytes"), work_path(spark, "warc-digests"))
    largest = (
        light.filter(F.col("_bytes") >= min_bytes)
        .groupBy("_digest", "_bytes")
        .agg(F.max("_page").alias("_largest"), F.count("*").alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    # Only rows that become revisits are looked up again; payloads move between
    # tasks only where Spark finds this table too large to hand out.
    revisits = write_table(
        light.join(largest, ["_digest", "_bytes"]).filter("NOT (_page <=> _largest)").distinct(),
        work_path(spark, "warc-revisits"),
    )
    names = {c: f"{c}_2" for c in ("_page", "_digest", "_bytes")}
    again = revisits.withColumnsRenamed(names).withColumn("_is_revisit", F.lit(True))
    same = [F.col(c).eqNullSafe(F.col(c2)) for c, c2 in names.items()]
    rows = page.join(again, same[0] & same[1] & same[2], "left").withColumn(
        "_is_revisit", F.coalesce("_is_revisit", F.lit(False))
    )
    eol = F.lit("\r\n")
    url = F.replace(F.replace(F.coalesce(F.col("_url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("_bytes").cast("string"),
        F.lit(GAP),
    )
    body = F.when(F.col("_is_revisit"), F.lit(b"")).otherwise(F.col("_payload"))
    length = F.octet_length(http) + F.octet_length(body)
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("_is_revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _urn(F.col("_page")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("_digest"),
        F.when(
            F.col("_is_revisit"),
            F.concat(F.lit("\r\nWARC-Refers-To: "), _urn(F.col("_largest")), F.lit(f"\r\nWARC-Profile: {PROFILE}")),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"),
        F.lit(GAP),
    )
    record = F.concat(header.cast("binary"), http.cast("binary"), body).cast("string")
    (
        rows.select(record.alias("value"))
        .write.option("lineSep", GAP)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", compression)
        .text(path)
    )


def _cuts(spark: SparkSession, path: str) -> DataFrame:
    """The file contents between cuts: ``_file``, ``_block``, ``_at`` (order of reading), ``_text``.

    The first text of a file still has its magic in front; the others lost theirs to the cut.
    The archives are read once and the cuts stored with their number: a second scan may be split
    otherwise and would number them otherwise.
    """
    raw = spark.read.option("lineSep", GAP + MAGIC).text(path)
    numbered = raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_text"),
    )
    stored = work_path(spark, "warc-text")
    numbered.write.option("compression", "zstd").parquet(stored)
    return spark.read.schema(numbered.schema).parquet(stored)


def _parsed(cuts: DataFrame) -> DataFrame:
    """Adds ``_head`` (the header without its end), ``_n`` and ``_h`` (bytes), ``_length`` (of the block).

    ``_length`` is NULL where the text can't be a record; ``_magic`` says whether it has its magic.
    """
    length = F.regexp_extract("_head", r"(?im)^content-length:[ \t]*(\d{1,15})[ \t]*\r?$", 1)
    looks = F.col("_head").rlike(r"^(WARC/1\.)?[01]\r\n")
    return (
        cuts.withColumn("_head", F.substring_index("_text", GAP, 1))
        .withColumn("_n", F.octet_length("_text").cast("long"))
        .withColumn("_h", F.octet_length("_head").cast("long"))
        .withColumn("_magic", F.startswith("_head", F.lit(MAGIC)))
        .withColumn("_length", F.when(looks, F.nullif(length, F.lit("")).cast("long")))
    )


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """The places of all cuts of the archives in a folder; see ``_placed``."""
    return _placed(spark, _cuts(spark, path))


def _placed(spark: SparkSession, cuts: DataFrame) -> DataFrame:
    """All cuts with their place: ``_at``, ``_file``, ``_start``, ``_succ``, ``_n``, ``_h``, ``_length``, ``_real``.

    ``_start`` is the offset of the magic, ``_succ`` the offset at which a record that
    starts there would be followed by the next; ``_real`` says whether it is reachable
    from the start of its file.
    """
    magic, gap = len(MAGIC), len(GAP)
    light = write_table(
        _parsed(cuts).select("_file", "_block", "_at", "_magic", "_n", "_h", "_length"),
        work_path(spark, "warc-cuts"),
    )
    # Bytes of a cut with what stood before it; the sum of those before it is its offset.
    split = W.partitionBy("_file", "_block").orderBy("_at")
    first = (F.col("_block") == 0) & (F.row_number().over(split) == 1)
    span = F.col("_n") + F.when(F.col("_first"), 0).otherwise(gap + magic)
    inner = light.withColumn("_first", first).withColumn("_span", span).withColumn(
        "_before", F.sum("_span").over(split.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_span")
    )
    totals = inner.groupBy("_file", "_block").agg(F.sum("_span").alias("_sum"))
    blocks = totals.withColumn(
        "_base",
        F.sum("_sum").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, W.currentRow))
        - F.col("_sum"),
    ).drop("_sum")
    start = F.when(F.col("_first"), 0).otherwise(F.col("_base") + F.col("_before") + gap)
    header = F.col("_h") + F.when(F.col("_first"), 0).otherwise(magic)
    fits = F.col("_magic") == F.col("_first")
    placed = inner.join(blocks, ["_file", "_block"]).withColumn("_start", start).withColumn(
        "_succ", F.when(fits, F.col("_start") + header + gap + F.col("_length") + gap)
    )
    placed = write_table(
        placed.select("_file", "_at", "_start", "_succ", "_n", "_h", "_length"), work_path(spark, "warc-cuts")
    )
    file = W.partitionBy("_file").orderBy("_start")
    candidates = placed.filter("_succ IS NOT NULL").select("_file", "_start", "_succ")
    near = candidates.withColumn("_next", F.lead("_start").over(file)).withColumn("_previous", F.lag("_succ").over(file))
    # A stretch starts where the chain is broken or a jump from elsewhere lands.
    landings = (
        near.filter("_next IS NULL OR _next <> _succ")
        .select("_file", F.col("_succ").alias("_start"))
        .distinct()
        .withColumn("_landing", F.lit(True))
    )
    marked = near.join(landings, ["_file", "_start"], "left").withColumn(
        "_new", F.expr("CAST(_landing IS NOT NULL OR _previous IS NULL OR _previous <> _start AS LONG)")
    )
    stretch = marked.withColumn(
        "_stretch", F.sum("_new").over(file.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    stretch = write_table(stretch.select("_file", "_start", "_succ", "_stretch"), work_path(spark, "warc-chain"))
    runs = stretch.groupBy("_file", "_stretch").agg(
        F.min("_start").alias("_head"), F.max_by("_succ", "_start").alias("_to")
    )
    real = _reachable(runs)
    good = stretch.join(real, ["_file", "_stretch"]).select("_file", "_start", F.lit(True).alias("_real"))
    return placed.join(good, ["_file", "_start"], "left").withColumn("_real", F.coalesce("_real", F.lit(False)))


def _reachable(runs: DataFrame) -> DataFrame:
    """The (``_file``, ``_stretch``) that can be reached from offset 0, by pointer jumping."""
    spark = runs.sparkSession
    runs = write_table(runs, work_path(spark, "warc-runs"))
    heads = runs.select("_file", F.col("_head").alias("_to"), F.col("_stretch").alias("_on"))
    jumps = write_table(
        runs.join(heads, ["_file", "_to"]).select("_file", "_stretch", "_on"), work_path(spark, "warc-jumps")
    )
    reached = write_table(
        runs.filter("_head = 0").select("_file", "_stretch"), work_path(spark, "warc-reached")
    )
    while not jumps.isEmpty():
        # Reached stretches hand on to where their jump lands, then every jump doubles.
        onward = reached.join(jumps, ["_file", "_stretch"]).select("_file", F.col("_on").alias("_stretch"))
        reached = write_table(reached.unionByName(onward).distinct(), work_path(spark, "warc-reached"))
        second = jumps.select("_file", F.col("_stretch").alias("_on"), F.col("_on").alias("_then"))
        jumps = write_table(
            jumps.join(second, ["_file", "_on"]).select("_file", "_stretch", F.col("_then").alias("_on")),
            work_path(spark, "warc-jumps"),
        )
    return reached


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("_head", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1), F.lit(""))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, with their payloads.

    ``warc_type``, ``record_id``, ``refers_to``, ``target_uri``, ``declared_digest``,
    ``payload`` (binary; empty for revisits), ``payload_bytes`` (of the full payload, by
    the HTTP header; for a revisit that of the payload it refers to).  Bytes that look
    like a record inside a payload give no row.  A file that does not begin with a
    record gives none; an archive without records gives an empty table.
    """
    cuts = _cuts(spark, path)
    placed = _placed(spark, cuts)
    file = W.partitionBy("_file").orderBy("_start")
    whole = file.rowsBetween(W.unboundedPreceding, W.currentRow)
    # A record that fills its cut is taken as it was read.  The others are the exceptions.
    owned = placed.withColumn("_owner", F.last(F.when(F.col("_real"), F.col("_start")), True).over(whole)).withColumn(
        "_last", F.lead("_start").over(file).isNull()
    )
    fills = F.expr("_real AND (_n = _h + 4 + _length OR _last AND _n >= _h + 4 + _length)")
    odd = write_table(
        owned.filter(~F.coalesce(fills, F.lit(False))).select("_at", "_file", "_start", "_owner"),
        work_path(spark, "warc-odd"),
    )
    cuts = cuts.select("_at", "_text")
    plain = cuts.join(odd.select("_at"), "_at", "left_anti").select("_text")
    parts = cuts.join(odd.filter("_owner IS NOT NULL"), "_at")
    joined = parts.groupBy("_file", "_owner").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_start", "_text"))), lambda part: part["_text"]
        ).alias("_parts")
    )
    split = joined.select(F.array_join("_parts", GAP + MAGIC).alias("_text"))
    records = _parsed(plain.unionByName(split))
    block = F.expr("substring(CAST(_text AS BINARY), CAST(_h + 5 AS INT), CAST(_length AS INT))")
    http = F.substring_index(F.col("_block").cast("string"), GAP, 1)
    return (
        records.withColumn("_block", block)
        .withColumn("_http", http)
        .select(
            _field("warc-type").alias("warc_type"),
            _field("warc-record-id").alias("record_id"),
            _field("warc-refers-to").alias("refers_to"),
            _field("warc-target-uri").alias("target_uri"),
            F.regexp_replace(_field("warc-payload-digest"), "(?i)^sha1:", "").alias("declared_digest"),
            F.expr("substring(_block, octet_length(_http) + 5)").alias("payload"),
            F.regexp_extract("_http", r"(?im)^content-length:[ \t]*(\d+)", 1).try_cast("long").alias("payload_bytes"),
        )
    )


def page_of(name: Column) -> Column:
    """The page id in a record's name; NULL for the empty name."""
    return F.nullif(F.regexp_extract(name, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """What the archives say about each page; digests of responses are computed anew."""
    read = read_warc(spark, path)
    response = F.col("warc_type") == "response"
    return read.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, base32_sha1(F.col("payload"))).otherwise(F.col("declared_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(~response, page_of(F.col("refers_to"))).alias("refers_to"),
    )
