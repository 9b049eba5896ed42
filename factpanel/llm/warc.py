"""WARC archives: writing pages with revisit records, and reading them by boundary chains.

Writing. Of pages with the same payload the one with the largest page_id becomes a
response, the others become revisits that refer to it and carry no payload. Records are
text rows with the record separator of WARC as line separator, so Spark's own committed
writer makes valid archives, and a lost task leaves no half record.

Reading. A task that starts in the middle of a file can only guess where records start:
at the magic of a record, which a payload may also contain. So every place with the
magic is a candidate, with the place where its record would end as its successor. Real
records are those on the chain of successors that starts at the start of the file.
Inside a split the chains are followed in the task, which leaves one pointer from each
candidate to the first place behind the split. Over splits, pointer jumping doubles the
known part of the chain in each round. A candidate off the chain is part of a payload,
and its bytes go back to the record that they came from. They are read from the archives
again, where the splits may be others, and found by file and digest of their bytes.

Defined cases
- A null html is an empty payload. Pages with empty payloads also revisit each other. A
  null url becomes an empty target; a null page_id sorts below any other, and its
  records carry an empty id. Of equal rows exactly one is the response.
- Other columns take no part. An empty table gives archives without records.
- Line ends and control characters of a url, those of Unicode too, are percent-encoded.
- An archive whose chain of records does not end exactly at its length raises an error, and so
  does a response whose payload has another digest than its header says.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factpanel.llm.common import new_path, stored

MAGIC = "WARC/1.1\r\n"
SEPARATOR = "\r\n\r\n"
#: Groups of equal payloads, and digests of parts of payloads, are broadcast up to this many
#: (they are short rows), and joined by a shuffle beyond.
BROADCAST_ROWS = 100_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hex digits at a time are four digits of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, revisits, refers_to)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("same", F.concat(F.sha2("payload", 256), F.octet_length("payload").cast("string")))
    alike = rows.groupBy("same", "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    groups = alike.groupBy("same").agg(F.max(F.struct("page_id", "url", "copies")).alias("kept"), F.sum("copies").alias("n"))
    repeated = stored(groups.where("n > 1").select("same", "kept"), "payloads")
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(repeated) if small else repeated, "same", "left").withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))}
    )
    stays = F.col("kept").isNull() | (
        F.col("page_id").eqNullSafe(F.col("kept.page_id")) & F.col("url").eqNullSafe(F.col("kept.url"))
    )

    def shown(df: DataFrame, revisits: Column) -> DataFrame:
        refers = F.when(revisits, F.col("kept.page_id")).alias("refers_to")
        return df.select("page_id", "url", "payload", "payload_bytes", "payload_digest", revisits.alias("revisits"), refers)

    ties = F.coalesce(F.col("kept.copies") > 1, F.lit(False))
    if repeated.where(ties).isEmpty():
        return shown(joined, ~stays)
    # rows that are equal in all columns: one is the response, the others only have a count
    one = joined.where(stays & ties).dropDuplicates(["same"])
    others = one.withColumn("payload", F.lit("")).withColumn("chunk", F.explode(F.expr("sequence(0L, (kept.copies - 2) DIV 10000)")))
    others = others.repartition("same", "chunk").withColumn(
        "copy", F.explode(F.expr("sequence(1L, least(10000L, kept.copies - 1 - chunk * 10000))"))
    )
    rest = shown(joined.where(~(stays & ties)), ~stays)
    return rest.unionByName(shown(one, F.lit(False))).unionByName(shown(others, F.lit(True)))


#: Control characters and the line ends of Unicode.
CONTROLS = [*map(chr, range(0x20)), *map(chr, range(0x7F, 0xA0)), "\u2028", "\u2029"]


def _on_one_line(url: Column) -> Column:
    """url with control characters and line ends percent-encoded, as its UTF-8 bytes."""
    encoded = url
    for c in CONTROLS:
        encoded = F.replace(encoded, F.lit(c), F.lit("".join(f"%{b:02X}" for b in c.encode())))
    return F.when(url.rlike(r"[\x00-\x1F\x7F-\x9F\u2028\u2029]"), encoded).otherwise(url)


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record_text(pages: DataFrame) -> Column:
    """One record without the separator that ends it."""
    one_line = _on_one_line(F.coalesce("url", F.lit("")))
    lines = [
        F.lit(MAGIC),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisits"), "revisit").otherwise("response"), F.lit("\r\n")),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("page_id")), F.lit("\r\n")),
        F.concat(F.lit("WARC-Target-URI: "), one_line, F.lit("\r\n")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n")),
        F.when(
            F.col("revisits"),
            F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _name(F.col("refers_to")), F.lit("\r\n")),
        ).otherwise(""),
        F.concat(
            F.lit("Content-Type: text/html\r\nContent-Length: "),
            F.when(F.col("revisits"), "0").otherwise(F.col("payload_bytes").cast("string")), F.lit(SEPARATOR),
        ),
        F.when(F.col("revisits"), "").otherwise(F.col("payload")),
    ]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record per page (page_id, url, html) below path."""
    rows = with_revisits(pages)
    rows.select(record_text(rows).alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, number, value): what stands between two magics, numbered in the order of
    the file. The first segment of a file is what stands before its first magic. Splits and
    numbers differ between reads, as they follow the cores that Spark has at the time."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("number"), "value",
    )


def _own_digest() -> Column:
    """Names a segment by its bytes, the same in every read."""
    return F.unhex(F.sha2(F.col("value").cast("binary"), 256))


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per segment: its bytes, what its header says, and, if the payload that the header
    promises lies in the segment whole, the bytes and the digest of that payload."""
    rows = _segments(spark, path).withColumn("head", F.substring_index("value", SEPARATOR, 1))
    data, head_bytes = F.col("value").cast("binary"), F.octet_length("head") + len(SEPARATOR)

    def field(name: str) -> Column:
        # header lines end with CR LF and nothing else
        return F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)

    rows = rows.withColumns(
        {
            "bytes": F.octet_length("value").cast("long"),
            "head_bytes": F.when(F.octet_length("head") + len(SEPARATOR) <= F.octet_length("value"), head_bytes).cast("long"),
            "kind": field("WARC-Type"), "name": field("WARC-Record-ID"), "said_digest": field("WARC-Payload-Digest"),
            "said_bytes": field("WARC-Payload-Length"), "refers": field("WARC-Refers-To"),
            "content": field("Content-Length"), "segment": _own_digest(),
        }
    ).withColumn("content", F.expr("try_cast(content AS BIGINT)"))
    whole = F.col("head_bytes") + F.col("content") + len(SEPARATOR) == F.col("bytes")
    payload = F.substr(data, (F.col("head_bytes") + 1).cast("int"), F.col("content").cast("int"))
    return rows.withColumn("digest", F.when(whole & (F.col("kind") == "response"), base32_sha1(payload))).drop("value", "head")


def _placed(candidates: DataFrame) -> DataFrame:
    """candidates with `place`, where the magic stands in the file, and `end`, the place
    behind the record that would start there (-1 if there is none)."""
    own = Window.partitionBy("file", "split").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("bytes") + len(MAGIC)
    splits = candidates.groupBy("file", "split").agg(F.sum(step).alias("width"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("base"))
    rows = candidates.withColumn("inside", F.coalesce(F.sum(step).over(own), F.lit(0))).join(splits, ["file", "split"])
    place = F.col("base") + F.col("inside") - len(MAGIC)
    length = len(MAGIC) + F.col("head_bytes") + F.col("content") + len(SEPARATOR)
    rows = rows.withColumn("place", place).where("place >= 0")
    return rows.withColumn("end", F.coalesce(F.col("place") + length, F.lit(-1))).drop("base", "inside")


def _steps(places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each candidate of a split, in order: the number of the next on its chain, -1 if the
    chain leaves the split, -2 if it breaks."""
    at = np.searchsorted(places, ends)
    hit = (at < len(places)) & (places[np.minimum(at, len(places) - 1)] == ends)
    return np.where(hit & (ends > places), at, np.where(ends > places[-1], -1, -2))


def _exits(table):
    """(file, place, goes): the first place behind the split on the chain of each candidate,
    found by pointer jumping among the candidates of the split."""
    table = table.sort_by("place")
    places, ends = (table.column(c).to_numpy() for c in ("place", "end"))
    step = _steps(places, ends)
    target = np.where(step < 0, np.arange(len(step)), step)
    while (target[target] != target).any():
        target = target[target]
    goes = np.where(step[target] == -1, ends[target], -1)
    return pa.table({"file": table.column("file"), "place": table.column("place"), "goes": pa.array(goes, pa.int64())})


def _on_chain(entries, table):
    """(file, split, number, place, end, owner) of a split's candidates: owner is the place of the
    record on the chain that the candidate starts or, off the chain, lies in, if it
    starts in this split."""
    table = table.sort_by("place")
    places, ends = (table.column(c).to_numpy() for c in ("place", "end"))
    step = _steps(places, ends)
    real = np.zeros(len(places), bool)
    for entry in entries.column("place").to_pylist():
        i = int(np.searchsorted(places, entry))
        i = i if i < len(places) and places[i] == entry else -1
        while i >= 0:
            real[i] = True
            i = int(step[i])
    last = np.maximum.accumulate(np.where(real, places, -1)) if len(places) else places
    columns = {c: table.column(c) for c in ("file", "split", "number", "place", "end")}
    return pa.table({**columns, "owner": pa.array(last, pa.int64())})


def _raise_unless_whole(segments: DataFrame, marks: DataFrame) -> None:
    """Raise if the records on the chain of a file do not end where the file does."""
    length = (F.sum(F.col("bytes") + len(MAGIC)) - len(MAGIC)).alias("length")
    ends = marks.where("place = owner").groupBy("file").agg(F.max("end").alias("end"))
    sizes = segments.groupBy("file").agg(length).join(ends, "file", "left")
    broken = sizes.where("length > 0 AND NOT end <=> length").select("file", "length", "end").first()
    if broken:
        raise ValueError(f"the records of {broken['file']} end at {broken['end']}, the file at {broken['length']}")


def chained(spark: SparkSession, path: str) -> DataFrame:
    """The candidates of the archives below path with `owner`: the place of the record that
    they start, or of the one that they are a part of."""
    # one read only: places are sums over all segments of the very same splits
    segments = stored(_candidates(spark, path), "segments")
    candidates = stored(_placed(segments.select("file", "split", "number", "bytes", "head_bytes", "content")), "candidates")
    pointers = candidates.select("file", "split", "place", "end").groupBy("file", "split")
    jumps = stored(pointers.applyInArrow(_exits, "file string, place long, goes long").where("goes >= 0"), "jumps")
    reached = candidates.where("place = 0").select("file", "place")
    splits = candidates.groupBy("file").agg(F.count_distinct("split").alias("n")).agg(F.max("n")).first()[0] or 1
    known = 1
    while known < splits:
        onward = jumps.select("file", "place", F.col("goes").alias("next"))
        further = reached.join(onward, ["file", "place"]).select("file", F.col("next").alias("place"))
        reached = stored(reached.unionByName(further), "reached")
        after = jumps.select("file", F.col("place").alias("goes"), F.col("goes").alias("last"))
        jumps = stored(jumps.join(after, ["file", "goes"]).select("file", "place", F.col("last").alias("goes")), "jumps")
        known *= 2
    # the chain enters a split once
    entries = stored(reached.join(candidates.select("file", "place", "split"), ["file", "place"]), "entries")
    marked = entries.groupBy("file", "split").cogroup(candidates.select("file", "split", "number", "place", "end").groupBy("file", "split"))
    marks = marked.applyInArrow(_on_chain, "file string, split long, number long, place long, end long, owner long")
    marks = stored(marks, "marks")
    _raise_unless_whole(segments, marks)
    # parts in a split before any of its records belong to the last record of a split before
    by_split = marks.groupBy("file", "split").agg(F.max("owner").alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    by_split = by_split.select("file", "split", F.max("last").over(before).alias("before"))
    marks = marks.join(by_split, ["file", "split"])
    owner = F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.col("before"))
    marks = marks.select("file", "split", "number", "place", owner.alias("owner"))
    return segments.join(marks, ["file", "split", "number"])


def _payloads(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    """(file, owner, payload) of the records with these parts, put together from them."""
    parts = parts.select("file", "segment", "owner", "place", F.when(F.col("place") == F.col("owner"), F.col("content")).alias("content"))
    wanted = stored(parts.select("file", "segment").distinct(), "wanted")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = _segments(spark, path).select("file", _own_digest().alias("segment"), "value")
    texts = texts.join(F.broadcast(wanted) if few else wanted, ["file", "segment"]).dropDuplicates(["file", "segment"])
    lost = F.raise_error(F.lit("a part of a payload was not found again")).cast("string")
    found = parts.join(texts, ["file", "segment"], "left").withColumn("value", F.coalesce("value", lost))
    whole = found.groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"), F.max("content").alias("content")
    )
    record = F.array_join(F.col("parts.value"), MAGIC)
    payload = F.substr(record, F.instr(record, SEPARATOR) + len(SEPARATOR))
    payload = F.substr(payload, F.lit(1), F.length(payload) - len(SEPARATOR))
    return whole.select("file", "owner", F.when(F.octet_length(payload) == F.col("content"), payload).alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, record_type, page_id, payload_bytes, payload_digest, refers_to) of every
    record on the chains. Digests of responses are those of the payload that was read;
    a revisit tells length and digest of the payload that it refers to."""
    rows = chained(spark, path)
    records = rows.where("place = owner")
    cut = records.where("kind = 'response' AND digest IS NULL").select("file", "owner")
    parts = stored(rows.join(cut, ["file", "owner"], "left_semi"), "parts")
    if parts.isEmpty():
        joined = records.withColumn("again", F.lit(None).cast("string"))
    else:  # payloads that hold the magic are put together from their parts
        again = _payloads(spark, path, parts).select("file", "owner", base32_sha1(F.col("payload")).alias("again"))
        joined = records.join(again, ["file", "owner"], "left")
    number = r"^<urn:page:(-?[0-9]+)>$"
    said = F.regexp_extract("said_digest", "^sha1:(.*)$", 1)
    own = F.coalesce("digest", "again")
    differs = F.raise_error(F.concat(F.lit("a payload differs from the digest of its record "), F.coalesce("name", F.lit("")))).cast("string")
    own = F.when((said == "") | own.eqNullSafe(said), own).otherwise(differs)
    return joined.select(
        "file", "place", F.col("kind").alias("record_type"),
        F.expr(f"try_cast(regexp_extract(name, r'{number}', 1) AS BIGINT)").alias("page_id"),
        F.when(F.col("kind") == "response", F.col("content")).otherwise(F.expr("try_cast(said_bytes AS BIGINT)")).alias("payload_bytes"),
        F.when(F.col("kind") == "response", own).otherwise(said).alias("payload_digest"),
        F.expr(f"try_cast(regexp_extract(refers, r'{number}', 1) AS BIGINT)").alias("refers_to"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, payload) of every response."""
    rows = chained(spark, path)
    responses = rows.where("place = owner AND kind = 'response'").select("file", "owner")
    return _payloads(spark, path, rows.join(responses, ["file", "owner"], "left_semi")).withColumnRenamed("owner", "place")


def write_and_read(pages: DataFrame) -> DataFrame:
    """What the archives of pages say, read back from the shared folder."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_records(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
