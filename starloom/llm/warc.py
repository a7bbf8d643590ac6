"""WARC archives: records written as monolithic gzip, normalised to one member a record with an offset index, read back.

Spark's text writer makes the monolithic archives.  The normaliser inflates each of them once
as a stream, so it holds one record at a time, and writes every record as a gzip member of its
own next to a sidecar index.  Archives lie in the shared scratch folder; their names follow
from the source file and their bytes from the records, and a task moves finished files into
place, so a task that runs again replaces a file by an equal one.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.session import scratch_path
from starloom.llm.common import saved

LEAST_REVISIT = 1000
RECORDS_PER_ARCHIVE = 20_000
CHUNK = 1 << 18
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = "archive string, offset long, length long, record_id string, record_type string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record_types(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Digest, size and response or revisit for every page, with its payload.

    Of equal payloads of at least ``least`` bytes the largest page_id is the response; rows
    that repeat that id are responses too, and a null id revisits unless all ids are null.
    Only digests that occur twice meet the pages in the join.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("bigint")})
    twice = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = saved(twice.select(F.col("digest").alias("_digest"), "kept"), "payloads")
    later = F.col("kept").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")))
    joined = rows.join(known, F.col("digest") == F.col("_digest"), "left")
    return joined.withColumns({"record_type": F.when(later, "revisit").otherwise("response"), "refers_to": F.when(later, F.col("kept"))}).drop("_digest", "kept")


def write_monolithic(typed: DataFrame, folder: str, records: int = RECORDS_PER_ARCHIVE) -> None:
    """Archives of whole WARC records, each file one gzip stream."""
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    line = lambda name, value: F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    block = F.concat(F.lit(HTTP), F.when(F.col("record_type") == "response", F.col("html")).otherwise(""))
    name = F.concat(F.lit("<urn:md5:"), F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url", "digest").cast("binary")), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), line("X-Payload-Length", F.col("bytes")), line("X-Page-ID", F.col("page_id")),
        line("X-Refers-To-Page-ID", F.col("refers_to")), line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block, F.lit("\r\n"))
    # the writer's line end is the second half of the blank line pair that ends a record
    typed.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", records).text(folder)


def opened(uri: str):
    """File system and path of a file that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


class Stream:
    """Records of one gzip stream, inflated in chunks."""

    def __init__(self, source):
        self.source, self.inflate, self.held, self.at = source, zlib.decompressobj(31), bytearray(), 0

    def fill(self) -> bool:
        while True:
            chunk = self.source.read(CHUNK)
            if not chunk:
                return False
            while chunk:  # several members may follow each other
                self.held += self.inflate.decompress(chunk)
                chunk = self.inflate.unused_data
                if self.inflate.eof:
                    self.inflate = zlib.decompressobj(31)
            if len(self.held) > self.at:
                return True

    def records(self):
        while True:
            while (head := self.held.find(b"\r\n\r\n", self.at)) < 0:
                if not self.fill():
                    if bytes(self.held[self.at:]).strip():
                        raise ValueError("archive ends within a record")
                    return
            fields = headers(bytes(self.held[self.at:head]))
            end = head + 4 + int(fields["content-length"]) + 4
            while len(self.held) < end:
                if not self.fill():
                    raise ValueError("archive ends within a record")
            yield fields, bytes(self.held[self.at:end])
            self.at = end
            if self.at > CHUNK:
                del self.held[:self.at]
                self.at = 0


def headers(raw: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode().split("\r\n")[1:])}


def normaliser(folder: str):
    def run(batches):
        for batch in batches:
            for path in batch["path"]:
                files, source = opened(path)
                _, root = opened(folder)
                name = re.sub(r"\W+", "-", source.rsplit("/", 1)[-1].split(".")[0]) + ".warc.gz"
                draft, at, lines = f"{root}/_{uuid.uuid4().hex}", 0, []
                with files.open_input_stream(source, compression=None) as stream, files.open_output_stream(draft, compression=None) as out:
                    for fields, record in Stream(stream).records():
                        member = gzip.compress(record, 6, mtime=0)
                        out.write(member)
                        lines.append(json.dumps({"archive": name, "offset": at, "length": len(member), "record_id": fields["warc-record-id"], "record_type": fields["warc-type"]}))
                        at += len(member)
                with files.open_output_stream(f"{draft}i", compression=None) as out:
                    out.write("".join(x + "\n" for x in lines).encode())
                files.move(draft, f"{root}/{name}")
                files.move(f"{draft}i", f"{root}/{name}.idx")
                yield pd.DataFrame({"archive": [name], "records": [len(lines)]})

    return run


def normalise(spark, source: str, folder: str) -> DataFrame:
    """Rewrite all monolithic archives of a folder; the sidecar index comes back as a table."""
    files, root = opened(folder)
    files.create_dir(root, recursive=True)
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    paths.mapInPandas(normaliser(folder), "archive string, records long").agg(F.sum("records")).collect()
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(folder)


def reader(folder: str):
    def run(batches):
        files, root = opened(folder)
        name = archive = None
        for batch in batches:
            rows = []
            for at in batch.itertuples():
                if at.archive != name:
                    name, archive = at.archive, files.open_input_file(f"{root}/{at.archive}")
                record = gzip.decompress(archive.read_at(at.length, at.offset))
                head = record.index(b"\r\n\r\n")
                fields = headers(record[:head])
                block = record[head + 4:head + 4 + int(fields["content-length"])]
                size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                rows.append((number(fields.get("x-page-id")), size, digest, fields["warc-type"], number(fields.get("x-refers-to-page-id")), fields.get("warc-target-uri")))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return run


def number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every indexed record, fetched by its offset: digest and size of the full payload."""
    return index.mapInPandas(reader(folder), READ)


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages, normalise the archives, read them back: one row per page.

    Null html is an empty payload; a null url or id leaves its header out and comes back null.
    """
    spark = pages.sparkSession
    raw, folder = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    write_monolithic(record_types(pages, least), raw)
    return read_archives(normalise(spark, raw, folder), folder)
