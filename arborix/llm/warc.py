"""WARC archives: writing pages with revisit records, and reading them back by verified chains of record boundaries.

Writing: the page of largest id stands for all pages of equal payload as a response; the others become revisit records without
a payload. Equal payloads are brought together by partial maxima, one row for each payload and task at most.

Reading: archives are read in splits at every place of the magic `WARC/1.`, so a payload that holds it gives rows too. Each
row that looks like a record's start is a candidate, and names where its successor must start. The places are prefix sums of the
rows' lengths. Pointer jumping from the file's start then keeps the candidates that are reached: after k rounds the first
2^k records of each file are known. A magic inside a payload is never the successor of a reached record, so it is rejected, also
if a whole well-formed record stands there. What the index needs of a record is taken while its row is read; only records that
a magic in their header or payload cut into several rows are read again and put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

MAGIC, END = "WARC/1.", "\r\n\r\n"
#: A header that is longer is none.
LONGEST_HEADER = 65_536
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def sha1_base32(content: Column) -> Column:
    """The SHA-1 of bytes in base 32, by ten hexadecimal digits and so eight others at a time."""
    part = lambda k: F.lpad(F.conv(F.substring(F.sha1(content), k, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*(part(k) for k in (1, 11, 21, 31))), _DIGITS, _BASE32)


def _record(kind: str, record_id: Column, url: Column, digest: Column, block: Column, refers: Column | None = None) -> Column:
    """A record without the two line ends after its block, as bytes."""
    line = lambda x: F.regexp_replace(F.regexp_replace(x, "\r", "%0D"), "\n", "%0A")
    fields = [F.lit(f"{MAGIC}1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <"), record_id, F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), line(F.coalesce(url, F.lit(""))), F.lit("\r\nWARC-Payload-Digest: sha1:"), digest]
    if refers is not None:
        fields += [F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <"), refers, F.lit(">")]
    fields += [F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END)]
    return F.concat(F.concat(*fields).cast("binary"), block)


def write(pages: DataFrame, path: str, least: int = 0, most: int = 10_000, compression: str = "gzip") -> None:
    """Archives of pages (page_id, url, html) in the folder `path`, of at most `most` records each.

    Of pages with equal payloads of at least `least` bytes the one with the largest (page_id, url) is a response, the others
    revisit it. Null html is an empty payload, a null url an empty one; a null page_id is smaller than any other and stays without a
    number; every repeated row is a record of its own; an empty table gives archives without records; further columns are ignored."""
    content = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), content.alias("content")).withColumn("payload", F.sha2("content", 256))
    shared = F.octet_length("content") >= least
    name = lambda page, payload: F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), payload)

    # A response for each payload; short payloads are told apart by their rows.
    first = rows.where(shared).groupBy("payload").agg(F.max(F.struct("page_id", "url", "content")).alias("r")).select("payload", "r.*", F.lit("").alias("nth"))
    short = rows.where(~shared).withColumn("nth", F.concat(F.lit(":"), F.monotonically_increasing_id().cast("string")))
    responses = first.unionByName(short).withColumn("digest", sha1_base32(F.col("content")))
    block = F.concat(F.concat(F.lit(_HTTP), F.octet_length("content").cast("string"), F.lit(END)).cast("binary"), F.col("content"))
    responses = responses.select(_record("response", F.concat(name(F.col("page_id"), F.col("payload")), "nth"), F.col("url"), F.col("digest"), block).alias("record"))

    light = rows.where(shared).select("page_id", "url", "payload", sha1_base32(F.col("content")).alias("digest")).groupBy("payload", "digest", "page_id", "url").count()
    kept = light.groupBy("payload").agg(F.max(F.struct("page_id", "url")).alias("kept"))
    again = light.join(kept, "payload").withColumn("times", F.col("count") - F.struct("page_id", "url").eqNullSafe(F.col("kept")).cast("long"))
    again = again.where("times > 0").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    own = F.concat(name(F.col("page_id"), F.col("payload")), F.lit(":revisit:"), F.xxhash64("url").cast("string"), F.lit(":"), F.col("k").cast("string"))
    revisits = again.select(_record("revisit", own, F.col("url"), F.col("digest"), F.lit(b""), name(F.col("kept.page_id"), F.col("payload"))).alias("record"))

    # Every row of this text is a record, and its line end what stands between records.
    responses.unionByName(revisits).select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", most).option("compression", compression).text(path)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic: (file, split, nth, value), in order by split and nth."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"), F.col("value"))


def _before(text: Column) -> Column:
    """How many bytes stand before the first empty line; all if there is none."""
    return F.octet_length(F.substring_index(text, END, 1))


def _block(value: Column, at: Column, size: Column) -> Column:
    return F.substring(value.cast("binary"), (at + 1).cast("int"), size.cast("int"))


def _payload(block: Column) -> Column:
    """What follows the HTTP head of a block; all of it where there is no such head."""
    http = block.cast("string").startswith("HTTP/") & (_before(block.cast("string")) < F.octet_length(block))
    return F.when(http, F.substring(block, (_before(block.cast("string")) + 5).cast("int"), 2147483647)).otherwise(block)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _candidates(scratch: Scratch, path: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their places, and the candidates: rows that start with a record's header."""
    rows = _rows(scratch.spark, path).withColumn("head", F.substring_index("value", END, 1)).withColumn("size", F.octet_length("value").cast("long")).withColumn("head_size", F.octet_length("head").cast("long"))
    size = _field(F.col("head"), "Content-Length").try_cast("long")
    rows = rows.withColumn("block", F.when(F.col("size") >= F.col("head_size") + len(END) + size, _block(F.col("value"), F.col("head_size") + len(END), size)))
    rows = rows.withColumn("payload", _payload(F.col("block")))
    seen = scratch.save(rows.select("file", "split", "nth", "size", "head_size", F.when(F.col("head_size") <= LONGEST_HEADER, F.col("head")).alias("head"), F.octet_length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("digest")))

    ordered = Window.partitionBy("file").orderBy("split", "nth")
    upto = ordered.rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("ended", F.col("head_size") < F.col("size"))
    seen = seen.withColumn("start", F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(upto), F.lit(0)) - len(MAGIC)).withColumn("run", F.coalesce(F.sum(F.col("ended").cast("int")).over(upto), F.lit(0)))
    seen = scratch.save(seen)

    # A header that the magic cuts goes on in the next rows, up to one that has an empty line.
    starts = (F.col("start") >= 0) & F.col("head").rlike("^[01]\r\n")
    whole = seen.where(starts & F.col("ended")).select("file", "split", "nth", "start", F.col("head").alias("header"), "head_size", "payload_bytes", "digest")
    ahead = Window.partitionBy("file", "run").orderBy("start")
    parts = seen.join(seen.where(starts & ~F.col("ended")).select("file", "run").distinct(), ["file", "run"], "left_semi")
    joined = F.array_join(F.collect_list("head").over(ahead.rangeBetween(0, LONGEST_HEADER)), MAGIC)
    cut = parts.withColumn("header", joined).withColumn("last", F.max("ended").over(ahead.rangeBetween(0, LONGEST_HEADER))).where(starts & ~F.col("ended") & F.col("last"))
    cut = cut.select("file", "split", "nth", "start", "header", F.octet_length("header").cast("long").alias("head_size"), F.lit(None).cast("long").alias("payload_bytes"), F.lit(None).cast("string").alias("digest"))
    found = whole.unionByName(cut).withColumn("block_size", _field(F.col("header"), "Content-Length").try_cast("long")).where("block_size IS NOT NULL")
    content = F.col("start") + len(MAGIC) + F.col("head_size") + len(END)
    return seen, scratch.save(found.withColumn("content", content).withColumn("next", content + F.col("block_size") + len(END)))


def reachable(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(file, start) of what is reached from start 0 of each file over links (file, start, next), by pointer jumping.

    After k rounds `known` holds the first 2^k places of each chain, and `jumps` leads 2^k places on."""
    links = links.select("file", "start", "next")
    jumps, known = links, scratch.save(links.where("start = 0").select("file", "start"))
    while True:
        ahead = known.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start"))
        new = scratch.save(ahead.join(links, ["file", "start"], "left_semi"))
        if new.isEmpty():
            return known
        more = scratch.save(known.unionByName(new))
        beyond = jumps.select("file", F.col("start").alias("next"), F.col("next").alias("beyond"))
        further = scratch.save(jumps.join(beyond, ["file", "next"]).select("file", "start", F.col("beyond").alias("next")))
        scratch.drop(known, new, *([jumps] if jumps is not links else []))
        known, jumps = more, further


def _verified(scratch: Scratch, path: str) -> tuple[DataFrame, DataFrame]:
    """All rows, and the candidates that their file's chain reaches and that end within the file."""
    seen, candidates = _candidates(scratch, path)
    ends = seen.groupBy("file").agg(F.max(F.col("start") + len(MAGIC) + F.col("size")).alias("file_end"))
    good = scratch.save(candidates.join(ends, "file").where(F.col("content") + F.col("block_size") <= F.col("file_end")).drop("file_end"))
    return seen, scratch.save(good.join(reachable(scratch, good), ["file", "start"], "left_semi"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, end, record_type, record_id, target_uri, refers_to, payload_bytes, payload_digest) of the records of all archives in a folder.

    Payloads are what follows an HTTP head in the block, or all of it; digests are bare SHA-1 in base 32 of the bytes read. A revisit has
    the payload's length and digest from the record that it refers to, nulls if there is no such record. A file's records end
    where its chain breaks: at its end, or before a record that is cut off or doesn't start where the last one says."""
    scratch = Scratch(spark, "warc")
    seen, found = _verified(scratch, path)
    whole, cut = found.where("digest IS NOT NULL"), found.where("digest IS NULL")
    if not cut.isEmpty():
        whole = whole.unionByName(_reread(spark, path, seen, found).select(*whole.columns))
    header = F.col("header")
    clean = lambda name: F.regexp_replace(_field(header, name), "^<|>$", "")
    records = scratch.save(whole.select("file", "start", F.col("next").alias("end"), _field(header, "WARC-Type").alias("record_type"), clean("WARC-Record-ID").alias("record_id"), _field(header, "WARC-Target-URI").alias("target_uri"), clean("WARC-Refers-To").alias("refers_to"), "payload_bytes", F.col("digest").alias("payload_digest")))
    scratch.keep(records)
    revisits, rest = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest"), records.where("record_type IS DISTINCT FROM 'revisit'")
    known = rest.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest").groupBy("refers_to").agg(F.max(F.struct("payload_bytes", "payload_digest")).alias("p")).select("refers_to", "p.*")
    return rest.unionByName(revisits.join(known, "refers_to", "left").select(*records.columns))


def _owned(spark: SparkSession, path: str, seen: DataFrame, found: DataFrame, which: Column) -> DataFrame:
    """The chosen records with their blocks as bytes, from all rows that they span."""
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    marks = found.select("file", "start", F.col("start").alias("mark"), which.alias("wanted"))
    owner = F.last("mark", True).over(in_file)
    rows = seen.select("file", "split", "nth", "start").join(marks, ["file", "start"], "left").withColumn("owner", owner).withColumn("wanted", F.last("wanted", True).over(in_file)).where("wanted")
    texts = _rows(spark, path).join(rows.select("file", "split", "nth", "start", "owner"), ["file", "split", "nth"])
    parts = texts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", F.col("value").cast("binary").alias("value")))).alias("parts"))
    joined = F.concat(F.aggregate(F.slice(F.col("parts"), 2, F.size("parts")), F.col("parts")[0]["value"], lambda a, x: F.concat(a, F.lit(MAGIC.encode()), x["value"])))
    return found.join(parts.select("file", F.col("owner").alias("start"), joined.alias("text")), ["file", "start"]).withColumn("block", _block(F.col("text"), F.col("head_size") + len(END), F.col("block_size"))).drop("text")


def _reread(spark: SparkSession, path: str, seen: DataFrame, found: DataFrame) -> DataFrame:
    """The records that several rows make, with their payloads' lengths and digests."""
    own = _owned(spark, path, seen, found, F.col("digest").isNull()).withColumn("payload", _payload(F.col("block")))
    return own.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", sha1_base32(F.col("payload")))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, target_uri, payload) of the records that hold a payload themselves."""
    scratch = Scratch(spark, "warc")
    seen, found = _verified(scratch, path)
    header = F.col("header")
    own = _owned(spark, path, seen, found, F.coalesce(_field(header, "WARC-Type"), F.lit("")) != "revisit")
    return own.select(F.regexp_replace(_field(header, "WARC-Record-ID"), "^<|>$", "").alias("record_id"), _field(header, "WARC-Type").alias("record_type"), _field(header, "WARC-Target-URI").alias("target_uri"), _payload(F.col("block")).alias("payload"))


def page_of(record: Column) -> Column:
    """The page_id in a record's name; null where the page had none."""
    return F.regexp_extract(record, "^urn:page:(-?[0-9]*):", 1).try_cast("long")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of pages written to archives and read back."""
    scratch = Scratch(pages.sparkSession, "archives")
    path = f"{scratch.base}/warc"
    write(pages, path, least)
    records = index(pages.sparkSession, path)
    scratch.delete(path)
    return records.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))


_PART = f"translate(to_base(('0x' || substr(h, {{k}}, 10))::BIGINT, 32, 8), '{_DIGITS}', '{_BASE32}')"
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, row_number() OVER own AS nth, first_value(page_id) OVER own AS kept
    FROM p WINDOW own AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, {" || ".join(_PART.format(k=k) for k in (1, 11, 21, 31))} AS payload_digest,
    CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN kept END AS refers_to
FROM d
"""
