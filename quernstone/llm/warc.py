"""Deterministic sharded WARC archives (operator 12), as a Spark data source.

Pages are sorted by id, URL and digest into shards, each a range of that order.
The bounds come from the rows alone: a bounded sample of keys with the smallest
hashes, and every key that would fill a shard by itself, which is dealt over
several.  Rows that are equal in all three travel as one row and a number.  A
task writes its shards record by record, each record a gzip member, and starts
a new file when the compressed size is reached; headers, record ids and digests
are made anew from the content, so the same pages give the same bytes, however
they were dealt before.  Files get temporary names, one folder for each attempt of a task.  The
commit renames the files of the attempts that Spark accepted and then the
manifest; an archive without a manifest is not there.

Of equal payloads only one is stored, the others are revisit records, so large
groups of copies move no payloads.  Reading takes the files that the manifest
names, checks their size and every digest, and finds what revisits refer to.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .common import BROADCAST_ROWS, NO_ID, shared_folder, stash, table

MANIFEST = "MANIFEST.json"
#: Payload bytes of a shard, and compressed bytes after which a file is full.
SHARD_BYTES, FILE_BYTES = 128 << 20, 64 << 20
#: Payloads below this many bytes are never revisits.
LEAST = 100
#: Keys that the bounds of shards are taken from.
SAMPLE = 1 << 16
#: Equal rows that travel as one.
COPIES = 1024
#: Bytes a record takes without its payload, about.
HEAD_BYTES = 700
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "file string, record_type string, record_id string, page_id bigint, url string, payload_digest string, payload_bytes bigint, refers_to_id string, payload binary"


# Records ----------------------------------------------------------------------------------------------------------------


def record_id(*parts) -> str:
    """A name-based UUID of the parts."""
    digest = hashlib.sha256(json.dumps(parts).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def _uri(url: str | None) -> str:
    """The URL with what a header line cannot hold percent-encoded; the exact one is in WARC-X-Page."""
    return "urn:none:" if url is None else "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) or "urn:empty:"


def record(kind: str, rid: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers: tuple[str, str | None] | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url)}"]
    if refers:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers[0]}", f"WARC-Refers-To-Target-URI: {_uri(refers[1])}", f"WARC-Refers-To-Date: {date}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http;msgtype=response"]
    lines += [f"WARC-X-Page: {json.dumps({'id': page_id, 'url': url})}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(name: str, date: str) -> bytes:
    block = b"software: quernstone\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('warcinfo', name)}", f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of a gzipped archive that comes in chunks; one record is held at a time."""
    held, inflate = bytearray(), zlib.decompressobj(31)

    def more() -> bool:
        nonlocal inflate
        for chunk in chunks:
            while chunk:
                held.extend(inflate.decompress(chunk))
                chunk = inflate.unused_data
                if inflate.eof:
                    inflate = zlib.decompressobj(31)
            return True
        return False

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("an archive ends within a header")
                return
        lines = held[:end].decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        size, at = int(headers["content-length"]), end + 4
        while len(held) < at + size + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        yield headers, bytes(held[at : at + size])
        del held[: at + size + 4]


# Data source ------------------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


@dataclass
class WarcFile(InputPartition):
    entry: dict


class _Roll:
    """One file being written."""

    def __init__(self, fs, folder: str, attempt: str, shard: int, number: int, date: str):
        self.name, self.fs = f"shard-{shard:06d}-{number:05d}.warc.gz", fs
        self.at = f"{folder}/_temporary/{attempt}/{self.name}"
        self.out, self.size, self.n, self.sha = fs.open_output_stream(self.at, compression=None), 0, 0, hashlib.sha256()
        self.add(info(self.name, date))

    def add(self, content: bytes) -> None:
        press = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = press.compress(content) + press.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size, self.n = self.size + len(member), self.n + 1

    def done(self) -> dict:
        self.out.close()
        return {"name": self.name, "at": self.at, "bytes": self.size, "records": self.n, "sha256": self.sha.hexdigest()}


class WarcWriter(DataSourceArrowWriter):
    """Writes rows that come sorted within their shards."""

    def __init__(self, options: dict[str, str]):
        self.uri, self.limit, self.date = options["path"], int(options.get("fileBytes", FILE_BYTES)), options.get("date", DATE)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        attempt, done, file = uuid.uuid4().hex, [], None
        fs.create_dir(f"{folder}/_temporary/{attempt}")
        shard, number = None, 0
        for batch in iterator:
            columns = [batch.column(c) for c in range(10)]
            for r in range(batch.num_rows):
                s, pid, url, digest, size, kind, first, copies, first_url, payload = (c[r].as_py() for c in columns)
                page = pid if pid != NO_ID else None
                for n in range(first, first + copies):
                    if s != shard or file.size >= self.limit:
                        shard, number = s, 0 if s != shard else number + 1
                        if file:
                            done.append(file.done())
                        file = _Roll(fs, folder, attempt, shard, number, self.date)
                    stored = record_id("first", digest)
                    revisit = kind == "revisit" or (kind == "first" and n > 0)
                    rid = stored if kind == "first" and not revisit else record_id(kind, pid, url, digest, n)
                    refers = (stored, first_url) if revisit else None
                    file.add(record("revisit" if revisit else "response", rid, page, url, digest, size, payload, refers, self.date))
        if file:
            done.append(file.done())
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["name"])
        if len({f["name"] for f in files}) < len(files):
            raise RuntimeError("a shard was written by two tasks")
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: fs.move(f["at"], f"{folder}/{f['name']}"), files))
        manifest = {"version": 1, "records": sum(f["records"] for f in files), "files": [{k: f[k] for k in ("name", "bytes", "records", "sha256")} for f in files]}
        temporary = f"{folder}/_temporary/{uuid.uuid4().hex}.json"
        fs.create_dir(f"{folder}/_temporary")
        with fs.open_output_stream(temporary) as out:
            out.write(json.dumps(manifest, indent=1).encode())
        fs.move(temporary, f"{folder}/{MANIFEST}")
        fs.delete_dir(f"{folder}/_temporary")

    def abort(self, messages: list[Written | None]) -> None:
        """Temporary files stay until the next commit; without a manifest nothing reads them."""


class WarcReader(DataSourceReader):
    """A partition for each file that the manifest names; yields the columns that the schema asks for."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.uri, self.columns = options["path"], schema.names

    def partitions(self) -> list[WarcFile]:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
            return [WarcFile(e) for e in json.loads(f.read())["files"]]

    def read(self, partition: WarcFile | None) -> Iterator[tuple]:
        if partition is None:  # an archive of no files
            return
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        sha, size, n, name = hashlib.sha256(), 0, 0, partition.entry["name"]

        def chunks():
            nonlocal size
            with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
                while chunk := f.read(1 << 20):
                    sha.update(chunk)
                    size += len(chunk)
                    yield chunk

        for h, block in records(chunks()):
            n += 1
            if h["warc-type"] == "warcinfo":
                continue
            digest, response = h["warc-payload-digest"].removeprefix("sha256:"), h["warc-type"] == "response"
            payload = block[block.index(b"\r\n\r\n") + 4 :] if response else None
            if hashlib.sha256(block).hexdigest() != h["warc-block-digest"].removeprefix("sha256:") or (response and hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"{name}: record {h['warc-record-id']} differs from its digest")
            page = json.loads(h["warc-x-page"])
            row = {
                "file": name, "record_type": h["warc-type"], "record_id": h["warc-record-id"], "page_id": page["id"], "url": page["url"], "payload_digest": digest,
                "payload_bytes": len(payload) if response else None, "refers_to_id": h.get("warc-refers-to"), "payload": payload,
            }
            yield tuple(row[c] for c in self.columns)
        if (size, n, sha.hexdigest()) != tuple(partition.entry[k] for k in ("bytes", "records", "sha256")):
            raise ValueError(f"{name} differs from the manifest")


class WarcSource(DataSource):
    """``spark.read.format("warc")``, with a schema of fewer columns where payloads are not wanted, and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        fs, folder = pafs.FileSystem.from_uri(self.options["path"])
        if fs.get_file_info(f"{folder}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise ValueError(f"{self.options['path']} holds an archive")
        return WarcWriter(dict(self.options))


# Shards -----------------------------------------------------------------------------------------------------------------


def bounds_of(sample: list[tuple[tuple, float]], shards: int) -> list[tuple[tuple, int, int]]:
    """(key, first shard, last shard) in order of (key, weight): shards of about equal weight.

    A key that is heavier than a shard spans several; a key between two bounds
    is in the last shard of the lower one.
    """
    total, passed, bounds, shard = sum(w for _, w in sample), 0.0, [], 0
    for key, weight in sorted(sample, key=lambda s: s[0]):
        first = min(int(passed * shards / total), shards - 1)
        passed += weight
        last = min(max(int(passed * shards / total), first), shards - 1)
        if not bounds or first > shard or last > first:
            bounds.append((key, first, last))
        shard = last
    return bounds


def _order(page_id: int | None, url: str | None, digest: str) -> tuple:
    return (page_id, url is not None, url or "", digest)


def _shard_column(bounds):
    """Shard of (id, url, digest, part, parts) by the bounds: the parts of a key that spans several are dealt over them in order."""

    @F.pandas_udf("int")
    def shard(page_id: pd.Series, url: pd.Series, digest: pd.Series, part: pd.Series, parts: pd.Series) -> pd.Series:
        keys = [k for k, _, _ in bounds.value]
        out = []
        for i, u, d, p, n in zip(page_id.tolist(), url.tolist(), digest.tolist(), part.tolist(), parts.tolist(), strict=True):
            key = _order(i, u, d)
            k, first, last = bounds.value[max(bisect_right(keys, key) - 1, 0)]
            out.append(first + p * (last - first + 1) // n if k == key else last)
        return pd.Series(out, dtype="int32")

    return shard


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS // 8 else df


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE, least: int = LEAST) -> None:
    """Writes a record for each page to path, which must not hold an archive yet.

    Payload is the text in UTF-8, null being empty.  Of records with equal
    payloads of at least `least` bytes, the one with the smallest id is a
    response (then the smallest URL, a null one first; of equal rows, one), the
    others revisit it; smaller ones are all responses.  A null id comes last
    and is null when read again.  Any URL can be stored, and is read back as it
    was.  No pages make an archive of no files.  Other columns of pages are not
    looked at.
    """
    spark, folder, key = pages.sparkSession, shared_folder(pages.sparkSession), ["id", "url", "digest"]
    spark.dataSource.register(WarcSource)
    text = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    full = pages.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(url_col).cast("string").alias("url"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    keys = stash(full.select(*key, F.octet_length("text").cast("bigint").alias("size")).groupBy(*key).agg(F.first("size").alias("size"), F.count("*").alias("n")), f"{folder}/keys")
    groups = keys.where(F.col("size") >= least).groupBy("digest").agg(F.min(F.struct("id", "url")).alias("first"), F.sum("n").alias("members")).where("members > 1").drop("members")
    groups = _few(stash(groups, f"{folder}/groups"))

    def kinds(df: DataFrame) -> DataFrame:
        mine = (F.col("id") == F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
        alone = F.when(F.col("size") >= least, "first").otherwise("single")
        return df.join(groups, "digest", "left").withColumn("kind", F.when(F.col("first").isNull(), alone).when(mine, "first").otherwise("revisit"))

    # Bounds of shards: weights of keys; those as heavy as a shard, and a sample of the others.
    stored = F.when(F.col("kind") == "single", F.col("n") * F.col("size")).when(F.col("kind") == "first", F.col("size")).otherwise(0)
    weighed = stash(kinds(keys).select(*key, (F.col("n") * HEAD_BYTES + stored).alias("weight")), f"{folder}/weights")
    total = weighed.agg(F.sum("weight")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    share = total / shards
    named = lambda df: [(_order(r.id, r.url, r.digest), float(r.weight)) for r in df.collect()]
    heavy = named(weighed.where(F.col("weight") >= share))  # one a shard at most
    some = named(weighed.where(F.col("weight") < share).orderBy(F.xxhash64(*key), *key).limit(min(SAMPLE, 64 * shards)))
    scale = (total - sum(w for _, w in heavy)) / max(sum(w for _, w in some), 1)
    bounds = bounds_of(heavy + [(k, w * scale) for k, w in some], shards) if total else []

    # Equal rows travel once, with their number.
    again = stash(keys.where("n > 1").select(*key, "n"), f"{folder}/again")
    once, many = full.withColumn("n", F.lit(1).cast("bigint")), None
    if again.take(1):
        same = _few(again.select(F.col("id").alias("i"), F.col("url").alias("u"), F.col("digest").alias("d"), F.col("n").alias("number")))
        on = (F.col("id") == F.col("i")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("digest") == F.col("d"))
        once = once.join(same, on, "left_anti")
        many = full.join(same, on, "left_semi").dropDuplicates(key).join(same, on).select(*full.columns, F.col("number").alias("n"))
    rows = kinds((once if many is None else once.unionByName(many)).withColumn("size", F.octet_length("text").cast("bigint")))
    rows = rows.withColumn("parts", F.ceil(F.col("n") / COPIES).cast("bigint")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    shard = _shard_column(spark.sparkContext.broadcast(bounds))(*key, "part", "parts")
    start = F.col("part") * COPIES
    holds = (F.col("kind") == "single") | ((F.col("kind") == "first") & (F.col("part") == 0))
    rows = rows.withColumn("shard", shard).select(
        "shard", *key, "size", "kind", start.alias("start"), F.least(F.lit(COPIES), F.col("n") - start).cast("int").alias("copies"), F.col("first.url").alias("first_url"), F.when(holds, F.col("text").cast("binary")).alias("payload"),
    )
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", *key, "start")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, 64)  # rows hold whole pages
    try:
        rows.write.format("warc").option("path", path).option("fileBytes", str(file_bytes)).option("date", date).mode("append").save()
    finally:
        spark.conf.set(batch, old)


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (id of the page that a revisit refers to), refers_to_id and record_id of an archive; with payloads also the payload, a revisit's being null.

    Every digest is checked.  payload_bytes of a revisit are those of the
    response that it refers to; one that refers to nothing is an error.
    """
    spark.dataSource.register(WarcSource)
    wanted = [c for c in RECORDS.split(", ") if payloads or not c.startswith("payload binary")]
    every = spark.read.format("warc").schema(", ".join(wanted)).option("path", path).load()
    narrow = spark.read.format("warc").schema(", ".join(c for c in wanted if not c.startswith("payload binary"))).option("path", path).load()
    told = stash(narrow.where("record_type = 'revisit'").select("refers_to_id").distinct())
    firsts = stash(narrow.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("first_bytes"), F.lit(True).alias("there")).join(told, "refers_to_id", "left_semi"))
    out = every.join(_few(firsts), "refers_to_id", "left")
    lost = F.raise_error(F.concat(F.lit("no response for "), F.col("refers_to_id"))).cast("bigint")
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).when(F.col("there"), F.col("first_bytes")).otherwise(lost)
    return out.withColumn("payload_bytes", size).drop("there", "first_bytes", "file")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
