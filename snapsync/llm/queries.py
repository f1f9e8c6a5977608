"""The registered queries of the corpus operators: thin digests of what the operators return."""

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from . import contamination, conversations, exact, licences, lines, neardup, packing, pii, quality
from . import repeats, runs, urls, warc
from .common import table

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_line_dedup")
def op1(spark, sf_dir):
    return lines.repeated_lines(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", "text"
    )


@query(
    "op2_exact_dedup",
    r"""with n as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from n group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from n join g using (text_sha256)""",
)
def op2(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


# The rules that the query judges pages by.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


@query("op3_url_filter")
def op3(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed(
        "id", "page_id"
    )


@query("op4_near_dedup")
def op4(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "group_size", "kept"
    )


@query("op5_repeated_bytes")
def op5(spark, sf_dir):
    return repeats.repeated_bytes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query("op6_personal_data")
def op6(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
        )

    def counted(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *[counted(kind) for kind in pii.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op7_contamination")
def op7(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]
    )
    return contamination.find_contamination(docs, benchmark).select(
        F.col("id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query("op8_quality")
def op8(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    model = quality.fit(docs, labels.where(fold != 1))
    return quality.score(docs, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(
            F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) == 1, F.lit(False)
        ).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_licences")
def op9(spark, sf_dir):
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    starts = F.col("places.word")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("expressions", "; ").alias("expressions"),
    )


@query("op10_packing")
def op10(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path)


def looped(doc_id, words):
    """The damage that the query does to a tenth of the documents: from some word on they go round."""
    if doc_id is None or not words:
        return words
    group, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    first = group % len(words)
    period = 1 + (len(words) - first) // (3 + group % 8)
    rounds = -(-(len(words) - first) // period)
    return (words[:first] + words[first : first + period] * rounds)[: len(words)]


def run_digest(docs):
    """Digests of the runs of a table of documents, after the damage."""
    found = runs.periodic_runs(docs, rewrite=looped)
    run = F.col("runs")

    def stronger(best, other):
        """Exponents as fractions; the runs are in order, so that the first of equal ones stays."""
        more = other["length"] * best["period"] > best["length"] * other["period"]
        return F.when(best.isNull() | more, other).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    lines = F.transform(
        run, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", F.aggregate(run, none, stronger)).select(
        F.col("id").alias("doc_id"),
        F.size(run).cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    return run_digest(table(spark, sf_dir, "documents"))


def record_digest(pages):
    return warc.page_records(pages).withColumnRenamed("id", "page_id")


@query("op12_warc")
def op12(spark, sf_dir):
    return record_digest(table(spark, sf_dir, "pages"))


def damaged(conversations):
    """The damage that the query does to the rows of conversations, by a hash of their key."""
    conv_id, turn, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "text")
    )
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    changed = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        changed.otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_"),
    ).drop("_")


def repair_digest(conversations_table, **sizes):
    """One row per conversation of the undamaged table."""
    found = conversations.repair_conversations(damaged(conversations_table), **sizes)
    every = conversations_table.select("conv_id").distinct()
    every = every.withColumn("conv", conversations.key_of("conv_id"))
    both = every.join(found.reports, "conv", "left").join(found.text_hashes(), "conv", "left")

    def count(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("long")

    return both.select(
        "conv_id",
        count("gaps").alias("gaps"),
        *[count(f"n_{fault}").alias(fault) for fault in ("blank", "duplicate", "truncated")],
        count("illegal").alias("illegal"),
        count("cost").alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    return repair_digest(table(spark, sf_dir, "conversations"))
