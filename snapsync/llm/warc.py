"""WARC archives: writing pages, and reading records along a verified chain of boundaries.

Written archives are plain `.warc` streams: Spark's text writer puts the records' bytes one after the
other (the last byte of a record is the writer's line end), so that any file system that Spark reaches
will do, and readers can split a file anywhere.

Reading: a task cuts its part of a file at every `WARC/1.`, wherever it stands. Each cut that is followed
by a header with a length is a candidate, whose successor's offset follows from its own. Offsets are
sums of lengths, within a part first and then over the parts of a file. Candidates whose successor is the
next cut are drawn together into runs; pointer jumping from the file's start over the runs' ends then
tells which ones a chain of records reaches. What it doesn't reach is text inside a payload.

DataFrame functions only; the parts of a file are dealt out, never a file as a whole.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import salted_left_join, shared_folder, written

# What begins a record, and what ends its header and itself.
MAGIC = "WARC/1."
BLANK_LINE = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PART = ["file", "part"]


def in_part(so_far: bool = False):
    """The cuts of a part in order; with `so_far`, those up to the present one."""
    window = Window.partitionBy(*PART).orderBy("row")
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow) if so_far else window


def earlier_parts():
    window = Window.partitionBy("file").orderBy("part")
    return window.rowsBetween(Window.unboundedPreceding, -1)


def size_of(column) -> Column:
    return F.octet_length(column).cast("long")


# --- writing -----------------------------------------------------------------------------------


def with_refers_to(pages: DataFrame, id_col: str, payload: str, least: int) -> DataFrame:
    """Add `sha1`, `n_bytes` and `refers_to`: the largest id of the rows with the same payload, for the
    others of them. Only payloads that come again take part in the join, and large groups are salted."""
    data = F.col(payload).cast("binary")
    sized = pages.withColumns({"sha1": F.sha1(data), "n_bytes": size_of(data)})
    again = (
        sized.where(F.col("n_bytes") >= least)
        .select("sha1", "n_bytes", F.sha2(data, 256).alias("sha2"), F.col(id_col).alias("_id"))
        .groupBy("sha1", "sha2", "n_bytes")
        .agg(F.max("_id").alias("newest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and newest is not null")
        .select("sha1", "sha2", "n_bytes", "newest")
    )
    keyed = sized.withColumns(
        {"sha2": F.sha2(data, 256), "row": F.xxhash64(F.struct(F.col(id_col), "sha1"))}
    )
    # Written, so that its size is known: where few payloads come again, no page is moved.
    joined = salted_left_join(keyed, written(again), ["sha1", "sha2", "n_bytes"])
    return joined.withColumn(
        "refers_to", F.when(~F.col(id_col).eqNullSafe(F.col("newest")), F.col("newest"))
    ).drop("sha2", "row", "newest")


def lines_of(*parts) -> Column:
    """Header lines; null ones are left out."""
    return F.array_join(F.array_compact(F.array(*parts)), "\r\n")


def header(name: str, value) -> Column:
    return F.concat(F.lit(f"{name}: "), F.col(value) if isinstance(value, str) else value)


def header_text(text: Column) -> Column:
    """A value that keeps to its header line and holds no `WARC/1.`."""
    return F.replace(F.regexp_replace(text, r"[\x00-\x1F\x7F]", " "), F.lit(MAGIC), F.lit("WARC%2F1."))


def write_pages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
    records_per_file: int = 1_000_000,
) -> None:
    """Write one record per row of `pages` to a new folder of archives.

    Of the rows with equal payloads of `least_revisit` bytes or more, the one with the largest id is a
    `response` and the others are a `revisit` without the payload that refers to it; smaller payloads
    always are responses. Rows that share the largest id (repeated rows, say) all are responses, and so
    are rows of a payload that has no id at all; a null id is smaller than any. A null payload is empty,
    a null url gives no target. Control characters in a url become spaces, `WARC/1.` becomes `WARC%2F1.`.
    Other columns are ignored.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        header_text(F.col(f"`{url_col}`").cast("string")).alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).alias("payload"),
    )
    rows = with_refers_to(rows, "id", "payload", least_revisit)
    is_revisit = F.col("refers_to").isNotNull()

    def name(column):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(
        lines_of(
            F.lit("HTTP/1.1 200 OK"),
            F.lit("Content-Type: text/html; charset=utf-8"),
            header("Content-Length", F.col("n_bytes").cast("string")),
        ),
        F.lit(BLANK_LINE),
    )
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))
    block = F.when(is_revisit, F.lit(0)).otherwise(F.col("n_bytes")) + size_of("http")
    head = lines_of(
        F.lit(f"{MAGIC}1"),
        header("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", name("id")),
        header("WARC-Target-URI", "url"),
        header("WARC-Date", F.lit(date)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(is_revisit, header("WARC-Refers-To", name("refers_to"))),
        F.when(is_revisit, header("WARC-Profile", F.lit(PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response"),
        header("Content-Length", block.cast("string")),
    )
    record = F.concat(head, F.lit(BLANK_LINE), "http", body, F.lit(BLANK_LINE[:-1]))
    (
        rows.withColumn("http", http)
        .select(record.alias("value"))
        .write.option("lineSep", BLANK_LINE[-1])
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


# --- reading -----------------------------------------------------------------------------------


def field(head: Column, name: str, value: str = r"[^\r\n]*?") -> Column:
    """A header's value; null where there is none."""
    pattern = rf"(?i)\r\n{name}:[ \t]*({value})[ \t]*(?=\r\n|\z)"
    return F.nullif(F.regexp_extract(head, pattern, 1), F.lit(""))


def cuts(spark: SparkSession, folder: str, payload: bool) -> DataFrame:
    """What stands between two `WARC/1.`, with the fields of a record's header at its front.

    Columns: file, file_size, part (where the task's part of the file begins), row (in order within the
    part), n (bytes), head_bytes, length (null where no header is there), fields of the header, sha1 of the
    HTTP payload if the record ends here, and with `payload` the text itself.
    """
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    ended = F.substring_index("value", BLANK_LINE, 1)
    length = field(F.col("head"), "Content-Length", "[0-9]{1,18}").cast("long")
    is_header = (
        F.col("head").rlike(r"\A[0-9]\r\n")
        & (size_of("head") < F.col("n"))
        & field(F.col("head"), "WARC-Type").isNotNull()
    )
    block = F.substring(F.col("value").cast("binary"), F.col("head_bytes") + 1, F.col("length"))
    found = (
        raw.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("part"),
            F.monotonically_increasing_id().alias("row"),
            "value",
            size_of("value").alias("n"),
            ended.alias("head"),
        )
        .withColumn("length", F.when(is_header, length))
        .withColumn("head_bytes", size_of("head") + len(BLANK_LINE))
        .withColumn("block", F.when(F.col("n") >= F.col("head_bytes") + F.col("length"), block))
    )
    kept = [*PART, "file_size", "row", "n", "head_bytes", "length", *header_fields(F.col("head"))]
    kept += block_fields(F.col("block"))
    return found.select(*kept, *(["value"] if payload else []))


def header_fields(head: Column) -> list[Column]:
    return [
        F.lower(field(head, "WARC-Type")).alias("record_type"),
        field(head, "WARC-Record-ID").alias("record_id"),
        field(head, "WARC-Target-URI").alias("target"),
        field(head, "WARC-Refers-To").alias("refers_to"),
        F.lower(field(head, "WARC-Payload-Digest", "sha1:[0-9A-Fa-f]{40}")).substr(6, 40).alias("digest"),
    ]


def http_head(block: Column) -> Column:
    return F.substring_index(block.cast("string"), BLANK_LINE, 1)


def http_payload(block: Column) -> Column:
    """The bytes after the HTTP header; none where there is no such header."""
    return F.substring(block, F.octet_length(http_head(block)) + len(BLANK_LINE) + 1, F.octet_length(block))


def block_fields(block: Column) -> list[Column]:
    return [
        field(http_head(block), "Content-Length", "[0-9]{1,18}").cast("long").alias("http_length"),
        size_of(http_payload(block)).alias("payload_bytes"),
        F.sha1(http_payload(block)).alias("payload_sha1"),
    ]


def with_offsets(found: DataFrame) -> DataFrame:
    """Add `offset` (of the `WARC/1.` before the text; null for what precedes the first one of a file),
    `stop` (where the text ends) and, for candidates, `successor`."""
    is_first = (F.col("part") == 0) & (F.row_number().over(in_part()) == 1)
    magic = F.when(F.col("first"), F.lit(0)).otherwise(F.lit(len(MAGIC))).cast("long")
    inner = F.sum("span").over(in_part(so_far=True))
    placed = found.withColumn("first", is_first).withColumn("span", F.col("n") + magic)
    placed = placed.withColumn("inner", inner)
    base = F.sum("bytes").over(earlier_parts())
    parts = placed.groupBy(*PART).agg(F.sum("span").alias("bytes"))
    parts = parts.select(*PART, F.coalesce(base, F.lit(0)).alias("base"))
    start = F.col("stop") - F.col("span")
    return (
        placed.join(parts, PART)
        .withColumn("stop", F.col("base") + F.col("inner"))
        .withColumn("offset", F.when(~F.col("first"), start))
        .withColumn(
            "successor",
            F.when(
                F.col("offset").isNotNull(),
                F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length") + len(BLANK_LINE),
            ),
        )
        .drop("first", "span", "inner", "base")
    )


def with_runs(nodes: DataFrame) -> DataFrame:
    """Number, within its part, the stretches of cuts each of which is the successor of the one before.

    A stretch ends where a successor is no next cut of the part, and before each cut that is the
    successor of such a one; so a chain enters a stretch at its head only.
    """
    follows = F.lead("offset").over(in_part())
    nodes = nodes.withColumn("plain", F.coalesce(F.col("successor") == follows, F.lit(False)))
    targets = (
        nodes.where("not plain and successor is not null")
        .select("file", F.col("successor").alias("offset"))
        .distinct()
        .withColumn("entered", F.lit(True))
    )
    nodes = nodes.join(targets, ["file", "offset"], "left")
    before = F.lag("plain").over(in_part())
    is_head = ~F.coalesce(before, F.lit(False)) | F.coalesce("entered", F.lit(False))
    return nodes.withColumn("head", is_head.cast("int")).withColumn(
        "run", F.sum("head").over(in_part(so_far=True))
    )


def reached_runs(runs: DataFrame) -> DataFrame:
    """(file, head) of the runs that a chain from the file's start enters, by pointer jumping: each
    round doubles the length of the jumps, so that rounds grow with the logarithm of the longest chain."""
    heads = runs.select("file", F.col("head").alias("to"))
    jumps = runs.select("file", "head", F.col("successor").alias("to")).join(heads, ["file", "to"])
    jumps = written(jumps.select("file", "head", "to"))
    reached = runs.where("head = 0").select("file", "head")
    while not jumps.isEmpty():
        more = reached.join(jumps, ["file", "head"]).select("file", F.col("to").alias("head"))
        reached = written(reached.unionByName(more).distinct())
        onward = jumps.select("file", F.col("head").alias("to"), F.col("to").alias("beyond"))
        jumps = written(
            jumps.join(onward, ["file", "to"]).select("file", "head", F.col("beyond").alias("to"))
        )
    return reached


def chained(nodes: DataFrame) -> DataFrame:
    """Add `is_record`: a chain of records from the file's start reaches the cut, and the record has all
    its bytes; and `record`, the offset of the record that the cut belongs to."""
    nodes = written(with_runs(nodes))
    runs = nodes.groupBy(*PART, "run").agg(
        F.min("offset").alias("head"), F.max_by(F.struct("successor"), "offset").alias("last")
    )
    runs = written(runs.select(*PART, "run", "head", F.col("last.successor").alias("successor")))
    reached = runs.join(reached_runs(runs), ["file", "head"]).select(*PART, "run")
    nodes = nodes.join(reached.withColumn("reached", F.lit(True)), [*PART, "run"], "left")
    is_record = F.col("reached").isNotNull() & (F.col("successor") <= F.col("file_size"))
    nodes = nodes.withColumn("is_record", F.coalesce(is_record, F.lit(False)))
    # The last record at or before a cut: of its part, or else of the parts before.
    here = F.last(F.when(F.col("is_record"), F.col("offset")), ignorenulls=True)
    earlier = F.last("newest", ignorenulls=True).over(earlier_parts())
    parts = nodes.groupBy(*PART).agg(
        F.max(F.when(F.col("is_record"), F.col("offset"))).alias("newest")
    )
    nodes = nodes.withColumn(
        "here", here.over(in_part(so_far=True))
    ).join(parts.select(*PART, earlier.alias("earlier")), PART)
    return nodes.withColumn("record", F.coalesce("here", "earlier")).drop(
        *("plain", "entered", "head", "run", "reached", "here", "earlier")
    )


def read_records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives (`.warc`, not compressed) in a folder or file.

    Columns: file, offset, record_type, record_id, target, refers_to, digest (as the header states it, hex
    SHA-1), http_length, payload_bytes and payload_sha1 (of the stored payload after the HTTP header) and,
    with `payload`, the payload itself. Without it no text is moved but that of records whose payload
    holds `WARC/1.`, whose files are read once more.

    Only records that a chain from the file's start reaches are returned; after a place where the chain
    breaks (a damaged or cut file) nothing of that file is, see `archive_states`. Records without an HTTP
    header have an empty payload. An empty folder of archives gives no rows.
    """
    cut = cuts(spark, folder, payload)
    chain = written(chained(written(with_offsets(cut).where("offset is not null"))))
    whole = chain.where("is_record and n >= head_bytes + length")
    fields = ["file", "offset", "record_type", "record_id", "target", "refers_to", "digest"]
    measures = ["http_length", "payload_bytes", "payload_sha1"]
    block = F.substring(F.col("value").cast("binary"), F.col("head_bytes") + 1, F.col("length"))
    text = [http_payload(block).alias("payload")] if payload else []
    found = whole.select(*fields, *measures, *text)
    in_pieces = chain.where("is_record and n < head_bytes + length")
    if in_pieces.isEmpty():
        return found
    return found.unionByName(joined_records(spark, folder, chain, in_pieces, payload))


def joined_records(spark, folder, chain, in_pieces, payload: bool) -> DataFrame:
    """Records whose payload holds `WARC/1.`, put together from their pieces."""
    records = in_pieces.select(
        *("file", F.col("offset").alias("record"), "head_bytes", "length"),
        *("record_type", "record_id", "target", "refers_to", "digest"),
    )
    if not payload:
        files = in_pieces.select("file").distinct()
        again = cuts(spark, folder, True).join(files, "file", "left_semi")
        texts = with_offsets(again).where("offset is not null").select("file", "offset", "value")
        chain = chain.select("file", "offset", "record").join(texts, ["file", "offset"])
    pieces = chain.select("file", "offset", "record", "value").join(
        records.select("file", "record"), ["file", "record"], "left_semi"
    )
    ordered = F.sort_array(F.collect_list(F.struct("offset", "value")))
    texts = pieces.groupBy("file", "record").agg(F.array_join(ordered["value"], MAGIC).alias("value"))
    block = F.substring(F.col("value").cast("binary"), F.col("head_bytes") + 1, F.col("length"))
    joined = records.join(texts, ["file", "record"]).withColumn("block", block)
    return joined.select(
        *("file", F.col("record").alias("offset"), "record_type", "record_id", "target"),
        *("refers_to", "digest", *block_fields(F.col("block"))),
        *([http_payload(F.col("block")).alias("payload")] if payload else []),
    )


def archive_states(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: its size, how far the chain of records reaches, and whether to the end."""
    chain = chained(written(with_offsets(cuts(spark, folder, False)).where("offset is not null")))
    ends = chain.groupBy("file", "file_size").agg(
        F.coalesce(F.max(F.when(F.col("is_record"), F.col("successor"))), F.lit(0)).alias("reached")
    )
    return ends.withColumn("whole", F.col("reached") == F.col("file_size"))


def page_records(pages: DataFrame, **columns) -> DataFrame:
    """Write pages to archives in the shared folder and read them back: id, payload_bytes and
    payload_digest of the full payload, record_type, refers_to (an id, for revisits)."""
    folder = shared_folder(pages.sparkSession)
    write_pages(pages, folder, **columns)
    records = read_records(pages.sparkSession, folder, payload=False)
    is_revisit = F.col("record_type") == "revisit"

    def page(name):
        return F.nullif(F.regexp_extract(name, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")

    return records.select(
        page("record_id").alias("id"),
        F.when(is_revisit, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(is_revisit, F.col("digest")).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        "record_type",
        F.when(is_revisit, page("refers_to")).alias("refers_to"),
    )
