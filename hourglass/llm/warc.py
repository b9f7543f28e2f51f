"""WARC archives: writing with segmented records, and reading back by segment
reassembly (operator 6).

``write_pages`` writes a record per page. The payload is the page's HTML in
UTF-8 in an HTTP response with chunked transfer framing. Of pages with equal
payloads the one with the largest id is a ``response``, the others are
``revisit`` records that refer to it. A record whose block is longer than
``segment_bytes`` is cut into a first record and ``continuation`` records.
Files are written by Spark's text writer, whose line separator is the end of a
record, so any file system that Spark can write holds them; ``records_per_file``
bounds a file.

``read_records`` parses the files in tasks. Records that are whole are decoded
at once. Segments are grouped by the identifier of the record they continue,
put in order of their numbers, checked to be complete and as long as the last
segment says, joined, and then decoded as HTTP with chunked framing; only
segments are shuffled, and a group is one record. What can't be read has a
``problem`` and no payload; nothing is dropped.

A record's identifier is its page_id; for rows that share one, and rows without
one, a digest of url and payload and a number among equal rows follow. A revisit
names one of the responses with its own payload.

Defined cases: null html is an empty payload; a null url is recorded as the
record's identifier; line breaks in a url are percent-encoded; repeated rows
give a record each, which are both responses if they have the largest id of
their payload; payloads of any length are cut into segments; other columns than
page_id, url and html are ignored; a null page_id is never referred to and reads back as null; an
empty table gives an empty archive, which reads as no records.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.storage import new_path, small_batches, written

SEGMENT_BYTES = 16384
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 20_000
#: Equal rows that a task numbers at a time.
COPIES = 1000
END = "\r\n\r\n"
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = ("record_id string, record_type string, uri string, refers_to string, stated_digest string, "
                 "segment int, origin string, total long, payload binary, piece binary, problem string")


def digest(payload: bytes) -> str:
    import base64
    import hashlib
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload in chunked framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where it should")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP headers")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding") == b"chunked":
        return unchunked(body)
    return body[:int(fields[b"content-length"])] if b"content-length" in fields else body


def _record(kind: bytes, record_id: str, block: bytes, date: bytes, *fields: tuple[bytes, str]) -> bytes:
    head = [VERSION, b"WARC-Type: " + kind, b"WARC-Record-ID: <" + record_id.encode() + b">", b"WARC-Date: " + date]
    head += [k + b": " + v.encode() for k, v in fields]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + b"\r\n\r\n" + block


def page_records(record_id: str, uri: str, payload: bytes, refers_to: str | None, segment_bytes: int,
                 chunk_bytes: int, date: bytes) -> Iterator[bytes]:
    """The record of a page, without the end mark; more of them if it is cut."""
    about = [(b"WARC-Target-URI", uri), (b"WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if refers_to:
        yield _record(b"revisit", record_id, HTTP_HEAD, date, *about, (b"WARC-Profile", PROFILE.decode()),
                      (b"WARC-Refers-To", f"<{refers_to}>"), (b"Content-Type", "application/http; msgtype=response"))
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    about.append((b"Content-Type", "application/http; msgtype=response"))
    if len(block) <= segment_bytes:
        yield _record(b"response", record_id, block, date, *about)
        return
    parts = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record(b"response", record_id, parts[0], date, *about, (b"WARC-Segment-Number", "1"))
    for n, part in enumerate(parts[1:], 2):
        own = [(b"WARC-Segment-Origin-ID", f"<{record_id}>"), (b"WARC-Segment-Number", str(n))]
        if n == len(parts):
            own.append((b"WARC-Segment-Total-Length", str(len(block))))
        yield _record(b"continuation", f"{record_id}:{n}", part, date, (b"WARC-Target-URI", uri), *own)


def _payload() -> F.Column:
    return F.coalesce("html", F.lit("")).cast("binary")


def _key(sha: F.Column) -> F.Column:
    """A digest of url and payload."""
    return F.sha1(F.concat(F.coalesce(F.concat(F.lit("u"), F.col("url")), F.lit("")), F.lit(" "), sha))


def _name(page_id: str) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("null")))


def revisits(slim: DataFrame, repeated: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha, n, refers_to) of the pages whose payload a larger id has, too:
    the identifier of a response with that payload."""
    slim = slim.filter(F.col("n") >= min_bytes)
    shared = slim.groupBy("sha", "n").agg(F.max("page_id").alias("last"), F.min("page_id").alias("least")) \
        .filter("least < last").drop("least")
    pairs = slim.join(shared, ["sha", "n"]).filter("page_id < last").select("page_id", "sha", "n", "last").distinct()
    keys = slim.join(repeated, "page_id", "left_semi").groupBy(F.col("page_id").alias("last"), "sha", "n").agg(F.max("key").alias("key"))
    to = F.when(F.col("key").isNull(), _name("last")).otherwise(F.concat(_name("last"), F.lit(":"), "key", F.lit(":1")))
    return pairs.join(keys, ["last", "sha", "n"], "left").select("page_id", "sha", "n", to.alias("refers_to"))


def named(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(record_id, url, html, refers_to), a row for each row of ``pages``."""
    sha = F.sha1(_payload())
    slim = written(pages.filter("page_id IS NOT NULL").select("page_id", "url", sha.alias("sha"), F.octet_length(_payload()).alias("n"))
                   .withColumn("key", _key(F.col("sha"))).drop("url"), "warc-pages")
    repeated = written(slim.groupBy("page_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("page_id"), "warc-repeated")
    found = written(revisits(slim, repeated, min_bytes), "warc-revisits")
    # Ids of one row: the id names the record.
    known = found.join(repeated, "page_id", "left_anti").select("page_id", "refers_to", F.lit(False).alias("many")) \
        .unionByName(repeated.select("page_id", F.lit(None).cast("string").alias("refers_to"), F.lit(True).alias("many")))
    single = pages.filter("page_id IS NOT NULL").join(known, "page_id", "left").filter("NOT coalesce(many, false)") \
        .select(_name("page_id").alias("record_id"), "url", "html", "refers_to")
    # Others: equal rows are counted, then numbered in parts of COPIES, so that no task makes all of them.
    html = F.coalesce("html", F.lit("")).alias("html")
    others = pages.filter("page_id IS NULL").unionByName(pages.join(repeated, "page_id", "left_semi")) \
        .groupBy("page_id", "url", html).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumns({"sha": sha, "n": F.octet_length(_payload())}).withColumn("key", _key(F.col("sha"))) \
        .join(found, ["page_id", "sha", "n"], "left") \
        .withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), "rows", F.lit(COPIES).cast("long")))) \
        .repartition("key", "page_id", "first") \
        .withColumn("copy", F.explode(F.sequence("first", F.least("rows", F.col("first") + COPIES - 1)))) \
        .select(F.concat_ws(":", _name("page_id"), "key", F.col("copy").cast("string")).alias("record_id"), "url", "html", "refers_to")
    return single.unionByName(others)


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES,
                chunk_bytes: int = CHUNK_BYTES, records_per_file: int = RECORDS_PER_FILE, date: str = DATE) -> None:
    """Archives ``pages`` (page_id, url, html) under the folder ``path``."""
    small_batches(pages.sparkSession)
    rows = named(pages.select("page_id", "url", "html"), min_bytes)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            out, held = [], 0
            for record_id, url, html, to in zip(*(batch.column(k) for k in range(4))):
                record_id, url = record_id.as_py(), url.as_py()
                uri = record_id if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
                records = page_records(record_id, uri, (html.as_py() or "").encode(), to.as_py(),
                                       segment_bytes, chunk_bytes, date.encode())
                for r in records:
                    out.append(r)
                    held += len(r)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write \
        .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(stream) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields, block) of each record of a file."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields[b"content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a file ends within a record")
        yield fields, block


def _decoded(block: bytes, stated: str | None) -> tuple[bytes | None, str | None]:
    try:
        payload = http_payload(block)
    except ValueError as e:
        return None, str(e)
    if stated and stated != f"sha1:{digest(payload)}":
        return None, "the payload has another digest"
    return payload, None


def _records(spark: SparkSession, path: str, segments: bool) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches):
        import gzip
        import io

        import pyarrow as pa
        kinds = [pa.string()] * 5 + [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
        names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
        text = lambda b: None if b is None else b.decode("utf-8", "replace").strip("<>")

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                stream = io.BytesIO(raw)
                if raw[:2] == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
                rows, held = [], 0
                for f, block in parse(stream):
                    number = f.get(b"warc-segment-number")
                    if (number is not None) != segments:
                        continue
                    kind, stated = text(f.get(b"warc-type")), text(f.get(b"warc-payload-digest"))
                    payload = problem = None
                    if number is None and kind == "response":
                        payload, problem = _decoded(block, stated)
                    total = f.get(b"warc-segment-total-length")
                    rows.append((text(f.get(b"warc-record-id")), kind, text(f.get(b"warc-target-uri")),
                                 text(f.get(b"warc-refers-to")), stated, number and int(number),
                                 text(f.get(b"warc-segment-origin-id")), total and int(total), payload,
                                 block if number else None, problem))
                    held += len(block)
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, RECORD_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, uri, refers_to, stated_digest, segments, payload,
    problem) of the archives' records; those of type continuation are part
    of the record they continue."""
    small_batches(spark)
    columns = ["record_id", "record_type", "uri", "refers_to", "stated_digest", "segments", "payload", "problem"]
    whole = _records(spark, path, False).withColumn("segments", F.lit(1))
    pieces = _records(spark, path, True)
    first = F.col("segment") == 1
    groups = pieces.groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "uri", "refers_to", "stated_digest")],
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("segment", "piece"))).alias("pieces"))
    groups = groups.select("*", F.col("pieces.segment").alias("numbers"), F.col("pieces.piece").alias("blocks")) \
        .drop("pieces")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            payloads, problems, counts = [], [], []
            col = lambda n: batch.column(batch.schema.get_field_index(n)).to_pylist()
            for numbers, blocks, total, stated in zip(col("numbers"), col("blocks"), col("total"), col("stated_digest")):
                payload, problem = None, None
                if numbers != list(range(1, len(numbers) + 1)):
                    problem = f"segments {numbers[:20]}"
                elif total != sum(map(len, blocks)):
                    problem = f"{sum(map(len, blocks))} bytes instead of {total}"
                else:
                    payload, problem = _decoded(b"".join(blocks), stated)
                payloads.append(payload)
                problems.append(problem)
                counts.append(len(numbers))
            own = [batch.column(batch.schema.get_field_index(n)) for n in columns[:5]]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(counts, pa.int32()), pa.array(payloads, pa.binary()), pa.array(problems, pa.string())],
                names=columns)

    joined = groups.mapInArrow(run, "record_id string, record_type string, uri string, refers_to string, "
                                    "stated_digest string, segments int, payload binary, problem string")
    return whole.select(*columns).unionByName(joined)


def base32(hex40) -> F.Column:
    """Base 32 of 160 bits in hexadecimal: four letters for five digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for at in range(1, 41, 5):
        v = F.conv(F.substring(hex40, at, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(letters), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def query(pages: DataFrame) -> DataFrame:
    """Writes the archives, reads them back and tells what each record holds."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_pages(pages, path)
    number = lambda c: F.nullif(F.regexp_extract(c, r"^urn:page:(-?[0-9]+)", 1), F.lit("")).cast("long")
    records = read_records(spark, path).select(
        "record_id", number(F.col("record_id")).alias("page_id"), "record_type", "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha"), "problem")
    records = records.withColumn("ok", F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")))
                                 .otherwise(F.lit(True)).cast("boolean")).filter("ok")
    held = records.filter("record_type = 'response'").select("record_id", "page_id", "record_type", "refers_to", "payload_bytes", "sha")
    again = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to") \
        .join(held.select(F.col("record_id").alias("refers_to"), "payload_bytes", "sha"), "refers_to")
    return held.drop("record_id").unionByName(again).select("page_id", "payload_bytes", base32(F.col("sha")).alias("payload_digest"),
                                                            "record_type", number(F.col("refers_to")).alias("refers_to"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
b AS (SELECT *, list_transform(range(8), lambda i: CAST(('0x' || substr(h, CAST(i * 5 + 1 AS INT), 5)) AS BIGINT)) AS v FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((x >> 15) & 31) + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((x >> 10) & 31) + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((x >> 5) & 31) + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x & 31) + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM b
"""
