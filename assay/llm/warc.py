"""Deterministic sharded WARC writer, and a reader for what it wrote.

Records are sorted by page id and dealt to shards by ranges of it; those without id are spread over
all shards. The ranges come from a sample chosen by hash, so the same pages always give the same archives. Every record is a gzip member of
its own; a shard starts a new file when the next member would take the file over its compressed
size. Files are written under temporary names that differ per attempt, listed in a manifest by the
attempts that finished, renamed, and listed again in the final manifest, whose presence commits
the archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.shared import file_system, stored, tasks_for
from assay.session import written

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INFO_FIELDS = "software: assay\r\nformat: WARC File Format 1.1\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

# Fields of our own, beside those of the format.
PAGE_FIELD = "X-Page-Id"
REFERS_FIELD = "X-Refers-To-Page-Id"
BYTES_FIELD = "X-Payload-Length"

SHARD_BYTES = 16 << 20
FILE_BYTES = 4 << 20
MOST_SHARDS = 16_384
SAMPLE_A_SHARD = 256
MOST_SAMPLED = 1 << 20
FILES_A_TASK = 16
CRAWL_DATE = "2000-01-01T00:00:00Z"
UNSAFE = re.compile("[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | str | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest}')}>"


def member(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as one gzip member; the same input always gives the same bytes."""
    lines = [VERSION] + [f"{name}: {value}" for name, value in fields if value is not None]
    lines += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def common_fields(kind: str, page: int | str | None, url: str | None, digest: str, size: int, date: str):
    safe = None if url is None else UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    return [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(page, url, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", safe),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        (PAGE_FIELD, page), (BYTES_FIELD, size),
    ]


def response(page: int | str | None, url: str | None, payload: bytes, digest: str, date: str) -> bytes:
    return member(
        common_fields("response", page, url, digest, len(payload), date),
        HTTP_HEAD.format(len(payload)).encode() + payload,
    )


def revisit(
    page: int | str | None, url: str | None, digest: str, size: int, first: str | None,
    first_url: str | None, date: str,
) -> bytes:
    fields = common_fields("revisit", page, url, digest, size, date)
    fields += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", record_id(first, first_url, digest)),
        (REFERS_FIELD, first),
    ]
    return member(fields, HTTP_HEAD.format(size).encode())


def info(name: str, date: str) -> bytes:
    return member([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, "")),
        ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ], INFO_FIELDS.encode())


def shard_bounds(pages: DataFrame, shard_bytes: int) -> list[int]:
    """Page ids at which a new shard begins, one less than there are shards; an id of many pages
    may be several bounds.

    The ids are those of the pairs of id and url whose hash is below a threshold. It is set from
    the estimated number of pairs, which does not depend on partitions, so that about
    ``MOST_SAMPLED`` pairs reach the driver at most. Tables of more than ``MOST_SHARDS`` shards get
    larger shards.
    """
    pair = F.xxhash64("page_id", "url")
    known = F.col("page_id").isNotNull()
    total = pages.agg(
        F.sum(F.octet_length("payload").cast("long")).alias("bytes"),
        F.approx_count_distinct(F.when(known, pair), 0.02).alias("pairs"),
    ).first()
    shards = min(MOST_SHARDS, max(1, -(-(total["bytes"] or 0) // shard_bytes)))
    if shards == 1 or total["pairs"] == 0:
        return []
    share = min(shards * SAMPLE_A_SHARD, MOST_SAMPLED) / total["pairs"]
    chosen = F.lit(True) if share >= 1 else F.col("pair") < int(share * 2**64) - 2**63
    sample = pages.where(known).select("page_id", pair.alias("pair")).where(chosen).distinct()
    ids = np.sort(sample.select("page_id").toArrow()["page_id"].to_numpy())
    return [int(ids[len(ids) * i // shards]) for i in range(1, shards)] if len(ids) else []


def shard_of(bounds: list[int], page: int | None, url: str | None, sha1: str) -> int:
    """Shard of a record. Those without id are spread over all shards, and those of an id that is
    several bounds over the shards that begin with it, so that neither makes a shard large."""
    if page is None:
        first, last = 0, len(bounds)
    else:
        last = bisect_right(bounds, page)
        first = min(bisect_left(bounds, page) + 1, last)
    return first + zlib.crc32(f"{url} {sha1}".encode()) % (last - first + 1)


RECORDS_A_STEP = 256
RECORD_FIELDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("sha1", pa.string()), ("size", pa.int64()),
    ("shard", pa.int32()), ("record", pa.binary()),
])
MANIFEST = (
    "shard int, part int, temporary string, file string, records long, file_bytes long, sha1 string"
)
MANIFEST_COLUMNS = ["shard", "part", "temporary", "file", "records", "file_bytes", "sha1"]


class ShardFile:
    """One archive file under a temporary name; knows its size and digest while it grows."""

    def __init__(self, folder: str, shard: int, part: int, date: str):
        self.name = f"part-{shard:06d}-{part:05d}.warc.gz"
        self.key, self.folder = (shard, part), folder
        self.temporary = f"temporary/{self.name}.{uuid.uuid4().hex}"
        system, path = file_system(f"{folder}/{self.temporary}")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(path)
        self.digest, self.size, self.records = hashlib.sha1(), 0, 0
        self.add(info(self.name, date))

    def add(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return (*self.key, self.temporary, self.name, self.records, self.size,
                self.digest.hexdigest())


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES, date: str = CRAWL_DATE, id_column: str = "page_id",
    url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder``; returns the committed manifest.

    The payload is the html in UTF-8, empty for NULL. Of records with equal payloads of at least
    ``revisit_from`` bytes the one with the smallest page id is a response and the others revisit
    it; rows that tie for the smallest id are all responses. A NULL id sorts before the ids of its
    shard and is a response only if no equal payload has an id. A task writes one shard; only rows
    that are equal in id, url and html always share one. NULL urls have no target; blanks and control
    characters in urls are percent-encoded. An empty table gives an empty manifest. Other columns
    are not read.
    """
    spark = pages.sparkSession
    keyed = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    bounds = shard_bounds(keyed, shard_bytes)
    equal = (F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    # NULL ids come last here, so that they are first only among themselves.
    # Only payloads that occur more than once; written, so that the join's both sides are plain
    # scans and the partition of a hot payload is split.
    firsts = stored(
        keyed.select("page_id", "url", *equal).where(F.col("size") >= revisit_from).groupBy(
            "sha1", "size"
        ).agg(
            F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")).alias(
                "first"
            ),
            F.count(F.lit(1)).alias("records"),
        ).where("records > 1").select("sha1", "size", "first"),
        "warc-first",
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, RECORDS_A_STEP):
                rows = []
                for row in batch.slice(at, RECORDS_A_STEP).to_pylist():
                    page, url = row["page_id"], row["url"]
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    rows.append({
                        "page_id": page, "url": url, "sha1": row["sha1"], "size": row["size"],
                        "shard": shard_of(bounds, page, url, row["sha1"]),
                        "record": response(page, url, row["payload"], digest, date),
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD_FIELDS)

    records = keyed.select("page_id", "url", "payload", *equal).mapInArrow(
        compress, "page_id long, url string, sha1 string, size long, shard int, record binary"
    )
    is_response = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first.page_id"))
    sorted_rows = (
        records.join(firsts, ["sha1", "size"], "left")
        .select(
            "shard", "page_id", "url", "sha1", "size",
            F.when(is_response, F.col("record")).alias("record"),
            F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
        )
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "url", "sha1")
        # As text, since pandas would turn a column with NULLs into floating point.
        .withColumns({name: F.col(name).cast("string") for name in ("page_id", "first_id")})
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: ShardFile | None = None
        done: list[tuple] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                data = row.record
                if data is None:
                    digest = base64.b32encode(bytes.fromhex(row.sha1)).decode()
                    data = revisit(
                        row.page_id, row.url, digest, row.size, row.first_id, row.first_url, date
                    )
                if current is not None and (
                    current.key[0] != row.shard or current.size + len(data) > file_bytes
                ):
                    done.append(current.close())
                    following = current.key[1] + 1 if current.key[0] == row.shard else 0
                    current = ShardFile(folder, row.shard, following, date)
                if current is None:
                    current = ShardFile(folder, row.shard, 0, date)
                current.add(bytes(data))
        if current is not None:
            done.append(current.close())
        yield pd.DataFrame(done, columns=MANIFEST_COLUMNS)

    pending = written(sorted_rows.mapInPandas(write, MANIFEST), f"{folder}/pending")

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for temporary, name in zip(batch["temporary"], batch["file"], strict=True):
                system, source = file_system(f"{folder}/{temporary}")
                target = file_system(f"{folder}/{name}")[1]
                # A repeated attempt finds the file already renamed.
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, target)
                elif system.get_file_info(target).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{source} is listed but gone")
            yield batch

    return written(pending.mapInPandas(publish, MANIFEST), f"{folder}/manifest")


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, unpacked one by one."""
    while data:
        unpacker = zlib.decompressobj(31)
        yield unpacker.decompress(data)
        if not unpacker.eof:
            raise ValueError("a gzip member is cut off")
        data = unpacker.unused_data


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record; its length and block digest are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != VERSION or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record has the wrong version or length")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"{fields['WARC-Record-ID']} has the wrong block digest")
    return fields, block


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, target_uri string, file string, payload binary"
)
RECORD_COLUMNS = [
    "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri",
    "file", "payload",
]


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The page records of the committed files below ``folder``; digests are computed anew.

    ``payload`` is the html of responses with ``with_payload``, else NULL; revisits have none.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                system, path = file_system(f"{folder}/{name}")
                with system.open_input_file(path) as stream:
                    data = stream.read()
                rows = []
                for fields, block in map(parsed, members(data)):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(fields[BYTES_FIELD])
                    if kind == "response" and (size, digest) != (
                        len(payload), base32_sha1(payload)
                    ):
                        raise ValueError(f"{fields['WARC-Record-ID']} has the wrong payload")
                    rows.append((
                        fields.get(PAGE_FIELD), size, digest, kind, fields.get(REFERS_FIELD),
                        fields.get("WARC-Target-URI"), name,
                        payload if with_payload and kind == "response" else None,
                    ))
                found = pd.DataFrame(rows, columns=RECORD_COLUMNS)
                for number in ("page_id", "refers_to"):
                    found[number] = pd.array(
                        [None if x is None else int(x) for x in found[number]], dtype="Int64"
                    )
                yield found

    manifest = spark.read.parquet(f"{folder}/manifest").select("file", "shard", "part")
    tasks = tasks_for(spark, manifest.count(), FILES_A_TASK)
    files = manifest.repartition(tasks, F.xxhash64("shard", "part")).select("file")
    return files.mapInPandas(read, RECORD)
