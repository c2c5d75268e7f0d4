"""WARC archives written and read by Spark, with boundary-chain verification.

Reading cuts archives wherever a record's magic stands, also inside payloads. Each task
emits candidates with the offset of their successor, as their Content-Length tells it.
Candidates that follow one another without a gap form runs; pointer jumping over the
runs, from the start of each file, keeps what the chain of records reaches. Pieces that
it doesn't reach are parts of the payload before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.llm.links import join_dealt
from tickflow.llm.slots import bitmap, with_hit
from tickflow.llm.text import or_empty
from tickflow.session import materialize

# What the format prescribes.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
URN = "urn:x-page:"
DATE = "2000-01-01T00:00:00Z"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32: the digest's 160 bits in eight groups of four digits."""
    hexed = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    records_per_file: int = 4096,
) -> None:
    """Write one record per row, as files in ``path``.

    Of rows with equal payloads of at least ``least_bytes`` the one with the largest id is
    a response, the others are revisits of it without the payload; rows that repeat its id
    are responses too. Null ids rank below all others. A null payload is empty; a null
    URL is left out, and control characters and blanks in it are escaped. An empty table
    gives no record. Only payloads that occur twice are shuffled.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(url_col).alias("_url"),
        or_empty(payload_col).alias("_payload"),
    )
    keyed = rows.withColumn("_digest", payload_digest(F.col("_payload"))).withColumn(
        "_bytes", F.octet_length("_payload")
    )
    groups = (
        keyed.filter(F.col("_bytes") >= least_bytes)
        .groupBy("_digest")
        .agg(F.max("_id").alias("_holder"), F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    groups = materialize(groups.select("_digest", "_holder"), "payloads")
    hit = with_hit(keyed, ["_digest"], bitmap(groups, ["_digest"]), "_hit")
    # Payloads below the least size join no group, though a group may share their slot.
    alone = F.lit(None).cast("long")
    single = hit.filter(~F.col("_hit")).withColumn("_holder", alone)
    shared = join_dealt(hit.filter("_hit"), groups, "_digest", "left")
    typed = single.unionByName(shared).withColumn(
        "_revisit", F.col("_holder").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_holder"))
    )
    typed.select(_record()).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _record() -> Column:
    """A record up to the end of its block."""
    revisit = F.col("_revisit")
    urn = lambda c: F.concat(
        F.lit(f"<{URN}"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">")
    )
    url = F.regexp_replace("_url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("_bytes"),
        F.lit(END),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("_bytes"))
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", urn("_id")),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("WARC-Refers-To", F.when(revisit, urn("_holder"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length.cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    head = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(END))
    return F.concat(head, http, F.when(revisit, "").otherwise(F.col("_payload"))).alias("value")


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _number(digits: Column) -> Column:
    return F.when(digits.rlike("^[0-9]{1,18}$"), digits.cast("long"))


def _page(urn: Column) -> Column:
    digits = F.regexp_extract(urn, rf"{URN}(-?[0-9]+)>", 1)
    return F.when(digits != "", digits.cast("long"))


def _pieces(archives: DataFrame) -> DataFrame:
    """Where archives hold the magic: file, pos (of the magic), and what follows it.

    Text up to the next magic is in exactly one split, in order, so lengths add up to
    offsets: within a split by row, within a file by split.
    """
    size = F.octet_length("value").cast("long") + len(MAGIC)
    rows = archives.withColumn("_size", size)
    splits = (
        rows.groupBy("file", "split")
        .agg(F.sum("_size").alias("_all"))
        .withColumn(
            "_before",
            F.sum("_all").over(Window.partitionBy("file").orderBy("split")) - F.col("_all"),
        )
        .select(F.xxhash64("file", "split").alias("_part"), "_before")
    )
    order = Window.partitionBy("file", "split").orderBy("_row")
    placed = rows.withColumn("_to", F.sum("_size").over(order) - F.col("_size"))
    placed = placed.withColumn("_part", F.xxhash64("file", "split")).join(splits, "_part")
    # What stands before a file's first magic is no piece of a record.
    pos = F.col("_before") + F.col("_to") - len(MAGIC)
    return placed.withColumn("pos", pos).filter("pos >= 0").drop("_part", "_before", "_to", "_row")


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            "value",
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
        )
        .withColumn("_row", F.monotonically_increasing_id())
    )


def _parsed(archives: DataFrame) -> DataFrame:
    """Pieces' header fields, and of those that hold their whole block, its digest."""
    head = F.substring_index("value", END, 1)
    whole = archives.withColumn("_head", head).withColumn(
        "_length", _number(_field(F.col("_head"), "Content-Length"))
    )
    known = F.contains(F.col("value"), F.lit(END)) & F.col("_length").isNotNull()
    span = F.octet_length("_head") + len(END) + F.col("_length")
    block = F.substr(F.col("value"), F.length("_head") + len(END) + 1)
    return (
        whole.withColumn("_span", F.when(known, span))
        # A last record may lack what ends it.
        .withColumn("_over", F.octet_length("value") - F.col("_span"))
        .withColumn("complete", F.coalesce(F.col("_over").isin(0, len(END)), F.lit(False)))
        .withColumn("_rest", F.when(F.col("complete"), block))
        .withColumn("_block", F.expr(f"left(_rest, length(_rest) - if(_over > 0, {len(END)}, 0))"))
    )


def _described(df: DataFrame) -> list[Column]:
    """What a record is, from its head and block."""
    head, block = F.col("_head"), F.col("_block")
    http = F.substring_index(block, END, 1)
    payload = F.substr(block, F.length(http) + len(END) + 1)
    revisit = _field(head, "WARC-Type") == "revisit"
    told = F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha1:", "")
    bytes_ = F.when(revisit, _number(_field(http, "Content-Length"))).otherwise(
        F.octet_length(payload).cast("long")
    )
    own = F.when(revisit, told).otherwise(payload_digest(payload))
    return [
        _page(_field(head, "WARC-Record-ID")).alias("page_id"),
        _field(head, "WARC-Target-URI").alias("url"),
        _field(head, "WARC-Type").alias("record_type"),
        _page(_field(head, "WARC-Refers-To")).alias("refers_to"),
        F.when(block.isNotNull(), bytes_).alias("payload_bytes"),
        F.when(block.isNotNull(), own).alias("payload_digest"),
        F.when(block.isNotNull(), own.eqNullSafe(told)).alias("intact"),
    ]


FIELDS = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "intact")


def _reached(pieces: DataFrame) -> DataFrame:
    """(file, pos) of the pieces that the chain of records from their file's start reaches."""
    order = Window.partitionBy("file", "split").orderBy("pos")
    linked = pieces.select("file", "split", "pos", "next").withColumn(
        "_lead", F.lead("pos").over(order)
    )
    gaps = linked.filter("next IS NOT NULL AND NOT (next <=> _lead)")
    targets = gaps.select("file", F.col("next").alias("pos"), F.lit(1).alias("_target")).distinct()
    marked = linked.join(targets, ["file", "pos"], "left")
    joined = F.lag("next").over(order).eqNullSafe(F.col("pos")) & F.col("_target").isNull()
    run = F.sum(F.when(joined, 0).otherwise(1)).over(order)
    members = marked.withColumn("_run", run)
    runs = members.groupBy("file", "split", "_run").agg(
        F.min("pos").alias("head"), F.max_by("next", "pos").alias("jump")
    )
    members = materialize(members.select("file", "split", "_run", "pos"), "members")
    nodes = materialize(
        runs.withColumn("reached", F.col("head") == 0), "runs"
    )
    while True:
        step = nodes.filter("jump IS NOT NULL")
        ahead = nodes.select("file", F.col("head").alias("jump"), F.col("jump").alias("_far"))
        hits = (
            step.filter("reached").select("file", F.col("jump").alias("head")).distinct()
        ).withColumn("_hit", F.lit(True))
        nodes = materialize(
            nodes.join(ahead, ["file", "jump"], "left")
            .join(hits, ["file", "head"], "left")
            .select(
                *("file", "split", "_run", "head"),
                F.col("_far").alias("jump"),
                (F.col("reached") | F.coalesce("_hit", F.lit(False))).alias("reached"),
            ),
            "runs",
        )
        if nodes.filter("reached AND jump IS NOT NULL").isEmpty():
            break
    kept = nodes.filter("reached").select("file", "split", "_run")
    return members.join(kept, ["file", "split", "_run"]).select("file", "pos")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, intact.

    Ids are null where a record names none. Of revisits the digest and the size are those
    that the record tells, of others those of the payload found; ``intact`` is whether it
    matches the record's digest. Bytes that the chain of records of a file doesn't reach
    belong to the record before them; a chain that ends in a false successor ends there.
    """
    parsed = _parsed(_archives(spark, path))
    pieces = parsed.select(
        *("value", "file", "split", "_row", "complete", "_span"), *_described(parsed)
    )
    after = F.col("pos") + len(MAGIC) + F.col("_span") + len(END)
    found = _pieces(pieces).withColumn("next", after)
    found = materialize(found.drop("value", "_size", "_span"), "pieces")
    reached = materialize(_reached(found), "reached")
    records = found.join(reached, ["file", "pos"])
    whole = records.filter("complete").select(*FIELDS)
    cut = materialize(records.filter("NOT complete").select("file", "pos"), "cut")
    if cut.isEmpty():
        return whole
    return whole.union(_joined(_archives(spark, path), cut, reached))


def _joined(archives: DataFrame, cut: DataFrame, reached: DataFrame) -> DataFrame:
    """Records whose payloads hold the magic, put together from their pieces.

    Only pieces of files with such records are placed again, and only pieces of such
    records are brought together, each record by itself.
    """
    files = cut.select("file").distinct()
    pieces = _pieces(archives.join(files, "file", "left_semi"))
    owners = reached.join(files, "file", "left_semi").withColumn("_owner", F.col("pos"))
    order = Window.partitionBy("file").orderBy("pos")
    owned = (
        pieces.join(owners, ["file", "pos"], "left")
        .withColumn("_owner", F.last("_owner", ignorenulls=True).over(order))
        .join(cut.withColumnRenamed("pos", "_owner"), ["file", "_owner"], "left_semi")
    )
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda p: p["value"]
    )
    values = owned.groupBy("file", "_owner").agg(F.array_join(parts, MAGIC).alias("value"))
    parsed = _parsed(values)
    return parsed.select(*_described(parsed))
