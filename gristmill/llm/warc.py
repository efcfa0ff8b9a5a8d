"""WARC archives: write captures as transactions, read records back, assemble captures.

A capture is written as a request, a response (or a revisit of an equal payload) and a metadata
record, tied by ``WARC-Concurrent-To``. Records are put together by built-in functions and written
by Spark's text writer, whose line separator is the end of a record, so a lost task leaves no
half-written archive. Reading parses by ``Content-Length``, so payloads may hold anything.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions.names import quoted

#: Payloads of fewer bytes are always written in full.
MIN_REVISIT = 1000
#: Captures in one archive file, at most.
PER_FILE = 2000
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAIN = ("response", "revisit", "resource", "conversion")
RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "content_type string, payload_digest string, http_header string, payload binary, complete boolean, file string"
)


def mark_revisits(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """``pages`` with ``__digest``, ``__bytes`` and ``__leader`` (the key of the response to revisit, or null).

    Of equal payloads of ``MIN_REVISIT`` bytes or more, rows with the largest key are responses and
    the others revisit it. Null payloads are empty; a null key is smaller than all others. Only
    digests that occur more than once reach the join, whose page side Spark splits where one
    digest is hot.
    """
    body = F.coalesce(F.encode(F.col(quoted(payload)), "UTF-8"), F.lit(b""))
    marked = pages.withColumns({"__digest": F.sha1(body), "__bytes": F.octet_length(body).cast("bigint"), "__key": F.col(quoted(key))})
    leaders = marked.where(F.col("__bytes") >= MIN_REVISIT).groupBy("__digest", "__bytes").agg(F.max("__key").alias("__first"), F.count(F.lit(1)).alias("__n"))
    leaders = leaders.where("__n > 1").drop("__n")
    joined = marked.join(leaders, ["__digest", "__bytes"], "left")
    later = F.col("__first").isNotNull() & ~F.col("__key").eqNullSafe(F.col("__first"))
    return joined.withColumn("__leader", F.when(later, F.col("__first"))).drop("__first", "__key")


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value. Line breaks in values are escaped."""
    plain = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), plain, F.lit("\r\n")), F.lit(""))


def _record(kind: Column | str, record_id: Column, content_type: str, block: Column, lines: list[Column]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [_line("WARC-Type", kind), _line("WARC-Record-ID", record_id), _line("WARC-Date", F.lit(DATE)), *lines]
    head += [_line("Content-Type", F.lit(content_type)), _line("Content-Length", F.octet_length(block))]
    return F.concat(F.lit("WARC/1.1\r\n"), *head, F.lit("\r\n"), block, F.lit("\r\n"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Write every row as a transaction of three records below ``path``, gzip-compressed.

    The metadata record holds the key and, for revisits, that of the response. Null URLs leave out
    the target; null payloads are empty. Rows with the same key are separate captures.
    """
    marked = mark_revisits(pages, key, payload)
    urn = lambda: F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))
    marked = marked.withColumns({"__main": urn(), "__request": urn(), "__meta": urn()})
    body = F.coalesce(F.col(quoted(payload)).cast("string"), F.lit(""))
    revisit = F.col("__leader").isNotNull()
    target = _line("WARC-Target-URI", F.col(quoted(url)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("__bytes").cast("string"), F.lit("\r\n\r\n"))
    request = F.concat(F.lit("GET "), F.replace(F.replace(F.coalesce(F.col(quoted(url)), F.lit("/")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(" HTTP/1.1\r\n\r\n"))
    fields = F.concat(_line("key", F.col(quoted(key))), _line("refers-to", F.col("__leader")))
    tied = _line("WARC-Concurrent-To", F.col("__main"))
    records = F.array(
        _record("request", F.col("__request"), "application/http;msgtype=request", request, [target, tied]),
        _record(
            F.when(revisit, "revisit").otherwise("response"),
            F.col("__main"),
            "application/http;msgtype=response",
            F.when(revisit, http).otherwise(F.concat(http, body)),
            [target, _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__digest"))), _line("WARC-Profile", F.when(revisit, PROFILE))],
        ),
        _record("metadata", F.col("__meta"), "application/warc-fields", fields, [target, tied]),
    )
    text = marked.select(F.explode(records).alias("value"))
    text.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", 3 * PER_FILE).text(path)
    return path


def _parse(stream) -> Iterator[tuple[dict[str, list[str]], bytes, bool]]:
    """Headers, block and completeness of each record; the rest of a damaged archive is left out."""
    try:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                continue  # blank lines between records, or garbage
            headers: dict[str, list[str]] = {}
            while (line := stream.readline()) and line.strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers.setdefault(name.strip().lower(), []).append(value.strip())
            text = headers.get("content-length", ["0"])[0]
            size = int(text) if text.isascii() and text.isdigit() else 0
            block = stream.read(size)
            yield headers, block, len(block) == size
    except (EOFError, OSError):  # cut off inside the compressed stream
        return


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path`` (columns of ``RECORD``), plain or gzip.

    HTTP blocks are split into header and payload; other blocks are all payload. A file is read by
    one task, so archives should keep the usual size of a gigabyte or less. A record whose block
    is shorter than announced has ``complete`` false.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    names = [f.split()[0] for f in RECORD.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.binary() if n == "payload" else pa.bool_() if n == "complete" else pa.list_(pa.string()) if n == "concurrent_to" else pa.string()) for n in names]
        )

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for file, content in zip(*batch.columns, strict=True):
                raw, rows, held = io.BytesIO(content.as_py()), [], 0
                stream = gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
                for h, block, complete in _parse(io.BufferedReader(stream, 1 << 20)):
                    first = lambda n, h=h: h.get(n, [None])[0]
                    http = None
                    if (first("content-type") or "").startswith("application/http"):
                        http, _, block = block.partition(b"\r\n\r\n")
                        http = http.decode("utf-8", "replace")
                    digest = (first("warc-payload-digest") or "").removeprefix("sha1:") or None
                    rows.append(
                        (first("warc-record-id"), first("warc-type"), h.get("warc-concurrent-to", []), first("warc-refers-to"), first("warc-target-uri"),
                         first("warc-date"), first("content-type"), digest, http, block, complete, file.as_py())
                    )
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``main``, ``request`` (first of them), ``metadata`` and ``others``.

    A capture is a response, revisit, resource or conversion record. Another record belongs to it
    if either names the other in its concurrent-to identifiers, or if it names a record that does
    so. Records that belong to no capture, or lack an id, are left out; a record without partners
    is a capture alone. All columns of ``records`` are kept inside the nested values.
    """
    whole = F.struct(*[F.col(quoted(c)) for c in records.columns])
    known = records.where("record_id is not null")
    # Identifiers are read several times and stored, with the records around captures; captures,
    # which hold nearly all payload, are taken from the archives again instead.
    is_main = F.coalesce(F.col("type").isin(*_MAIN), F.lit(False))
    index = known.select("record_id", is_main.alias("is_main"), "concurrent_to", F.when(~is_main, whole).alias("part"))
    index = scratch.materialize(index, "record-ids")
    heads = index.select("record_id", "is_main", F.explode("concurrent_to").alias("to"))
    mains = known.where(F.col("type").isin(*_MAIN))
    ids = index.where("is_main").select(F.col("record_id").alias("main_id"))
    said = heads.where("not is_main").select(F.col("record_id").alias("part_id"), "to")
    direct = said.join(ids, F.col("to") == F.col("main_id")).select("part_id", "main_id")
    named = heads.where("is_main").select(F.col("to").alias("part_id"), F.col("record_id").alias("main_id"))
    near = direct.unionByName(named)
    over = said.join(near.select(F.col("part_id").alias("to"), "main_id"), "to").select("part_id", "main_id")
    ties = near.unionByName(over).distinct()
    parts = index.where("not is_main").select(F.col("record_id").alias("part_id"), "part")
    grouped = ties.join(parts, "part_id").groupBy("main_id").agg(F.sort_array(F.collect_list(F.struct("part_id", "part"))).alias("parts"))
    of = lambda test: F.transform(F.filter("parts", lambda p: test(p["part"]["type"])), lambda p: p["part"])
    nested = mains.select(F.col("record_id").alias("main_id"), whole.alias("main")).join(grouped, "main_id", "left")
    return nested.select(
        "main_id",
        "main",
        F.get(of(lambda t: t == "request"), F.lit(0)).alias("request"),
        F.coalesce(of(lambda t: t == "metadata"), F.array()).alias("metadata"),
        F.coalesce(of(lambda t: ~t.isin("request", "metadata")), F.array()).alias("others"),
    )


def field(metadata: Column, name: str) -> Column:
    """A field of the first metadata record of a capture."""
    text = F.decode(F.get(metadata, F.lit(0))["payload"], "UTF-8")
    found = F.regexp_extract(text, rf"(?:^|\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)
