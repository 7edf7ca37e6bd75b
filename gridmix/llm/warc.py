"""WARC archives with an index that is written first: (file, offset, length, url, digest) of every record.

Every record is a gzip member of its own, as WARC readers expect, so that a byte range of the file holds whole records.
Each task writes one archive to the shared folder and returns an index row per record; the index is a Parquet table.
Readers select index rows, sort them by file and offset, and fetch neighbouring records by one coalesced byte-range
read. Archive names are unique per task attempt, so a task that is run again leaves the first attempt's file unused
and the index never points at half a file.

Responses hold an HTTP head and the page; revisits hold the head alone and name the response by its record id, URL and
date. Record ids are made from page id and URL, so that revisits can name a record that another task writes. Pages have
no time of capture: all records bear ``DATE``.

Defined results: a null html is an empty payload, a null url an empty one; of records with equal payloads of
``least`` bytes or more that with the largest page_id is the response and the others revisit it (rows that repeat
that page_id are all responses, with one record id if their URL is the same too; a null page_id never is the largest
unless all are null, and then all are responses); ids and URLs may hold any characters; an empty table gives an empty index; other columns of the input are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import shared_dir, staged, table

#: Payloads shorter than this are never replaced by a revisit record.
LEAST = 1000
#: Byte ranges of one file are read together if no more than GAP bytes lie between them, up to READ bytes at once.
GAP, READ = 64 << 10, 8 << 20
#: Bytes of records that one task reads, about.
TASK = 8 << 20
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
INDEX = "file string, offset long, length long, page_id {id}, url string, digest string, record_type string, refers_to {id}"
#: Printable characters that stay as they are in a header field; all others are written in percent notation.
PLAIN = "!#$&'()*+,/:;=?@[]-._~% "
#: Fixed value: the profile that the WARC 1.1 standard gives to revisits of equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """The file system of a URI and the path in it; what pyarrow can open: file, hdfs, s3, gs, abfs."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def with_roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, size, digest, record_type, refers_to of every page.

    Digests are pre-aggregated before the shuffle; only those that occur twice are joined back.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    twice = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = staged(twice)  # so that both sides of the join are plain shuffles, of which Spark splits hot keys
    revisit = F.col("kept.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    return rows.join(twice, "digest", "left").select(
        "page_id", "url", "payload", "size", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept.page_id")).alias("refers_to"), F.when(revisit, F.col("kept.url")).alias("refers_to_url"),
    )


def record_id(page_id, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id!r} {url}')}>"


def record(row: dict) -> bytes:
    """A whole record, not yet compressed. Our own field holds the page id (no field: null)."""
    revisit = row["record_type"] == "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    if not revisit:
        block += row["payload"].encode("utf-8", "surrogatepass")
    fields = {"WARC-Type": row["record_type"], "WARC-Record-ID": record_id(row["page_id"], row["url"]), "WARC-Target-URI": quote(row["url"], PLAIN, errors="surrogatepass"), "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{row['digest']}"}
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(row["refers_to"], row["refers_to_url"]), "WARC-Refers-To-Target-URI": quote(row["refers_to_url"], PLAIN, errors="surrogatepass"), "WARC-Refers-To-Date": DATE}
        fields["X-Refers-To-Page"] = quote(str(row["refers_to"]), "")
    if row["page_id"] is not None:
        fields["X-Page-Id"] = quote(str(row["page_id"]), "")
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + END


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes one archive per task and returns the index, already stored as Parquet in the same folder."""
    kind = rows.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            offsets, lengths = [], []
            for row in batch.to_pylist():
                member = gzip.compress(record(row), 6, mtime=0)
                out.write(member)
                offsets.append(at)
                lengths.append(len(member))
                at += lengths[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(offsets)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), *(batch[c] for c in ("page_id", "url", "digest", "record_type", "refers_to"))],
                ["file", "offset", "length", "page_id", "url", "digest", "record_type", "refers_to"],
            )
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(write, INDEX.format(id=kind)))


def parse(member: memoryview) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields, fields of the HTTP head, and payload of one record."""
    whole = gzip.decompress(member)
    lines = lambda head: dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    cut = whole.index(END)
    fields = lines(whole[:cut])
    block = whole[cut + 4 : cut + 4 + int(fields["Content-Length"])]
    cut = block.index(END)
    return fields, lines(block[:cut]), block[cut + 4 :]


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, offset, length) of the reads for records sorted by offset."""
    i = 0
    while i < len(rows):
        a, end, j = rows[i][0], sum(rows[i]), i + 1
        while j < len(rows) and rows[j][0] - end <= gap and max(end, sum(rows[j])) - a <= most:
            end = max(end, sum(rows[j]))
            j += 1
        yield i, j, a, end - a
        i = j


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that index rows select, read by coalesced byte ranges: what each says of itself, and its payload.

    Rows are dealt by ranges of (file, offset), so one large archive is read by several tasks.
    """
    kind = index.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        for batch in batches:
            files, at, size = (batch[c].to_pylist() for c in ("file", "offset", "length"))
            out: list[list] = [[] for _ in range(5)]
            i = 0
            while i < len(files):
                j = i
                while j < len(files) and files[j] == files[i]:
                    j += 1
                with store.open_input_file(f"{path}/{files[i]}") as f:
                    for a, b, start, length in ranges(list(zip(at[i:j], size[i:j]))):
                        block = memoryview(f.read_at(length, start))
                        for k in range(i + a, i + b):
                            fields, http, body = parse(block[at[k] - start : at[k] - start + size[k]])
                            real = fields["WARC-Type"] == "response"
                            out[0].append(unquote(fields["X-Page-Id"]) if "X-Page-Id" in fields else None)
                            out[1].append(len(body) if real else int(http["Content-Length"]))
                            out[2].append(hashlib.sha1(body).hexdigest() if real else fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                            out[3].append(fields["WARC-Type"])
                            out[4].append(unquote(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None)
                i = j
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out, kinds)), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    tasks = 1 + (index.agg(F.sum("length")).first()[0] or 0) // TASK  # index rows are small: Spark would put all into one task
    picked = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    found = picked.mapInArrow(read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    return read_records(write_archives(with_roles(table(spark, sf_dir, "pages")), folder), folder)


SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM m
"""
