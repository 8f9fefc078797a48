"""WARC writer and reader: a deterministic sharded archive.

Records are range-sorted by page id; shard bounds depend on the ids alone.
Each task streams its shard into gzip members, one per record, and begins a
new file when the compressed size reaches a limit, so files, headers and
digests are the same on every run. Task files have names of the attempt and a
manifest is committed by Spark's writer; a second job renames what the
manifest lists, so a repeated or lost task leaves nothing half written.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest page id is the response and the others revisit it. The decisions are
rows of their own in the same range sort (id, refers_to), so a payload is
shuffled once.

Defined cases: a null payload is empty; null page ids come first, take part in
revisits as the smallest ids and have no X-Page-Id header; rows that repeat
the largest page id are all responses; a null URL gives an empty target. No
rows: no file, an empty result.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

REVISIT_BYTES = 1000
SHARD_BYTES = 16 << 20
FILE_BYTES = 64 << 20
PIECE = 8 << 20
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
MANIFEST = "shard int, seq int, part string, path string, records long, bytes long, first_id long, last_id long"
ROW = "page_id long, uri string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def record_id(page_id: int | None, sha1_hex: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1_hex}')}>"


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def make_record(page_id: int | None, uri: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response record, or a revisit of ``refers_to``."""
    sha1 = hashlib.sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, sha1.hexdigest())), ("WARC-Date", DATE),
              ("WARC-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in uri)),
              ("WARC-Payload-Digest", _digest(sha1.digest())),
              ("WARC-Block-Digest", _digest(hashlib.sha1(block).digest()))]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha1.hexdigest())),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """Uncompressed gzip members of a stream, one at a time."""
    unpack, out, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(size)):
        out.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            yield b"".join(out)
            data, unpack, out = unpack.unused_data, zlib.decompressobj(31), []
    if out and b"".join(out):
        raise ValueError("the archive ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of a record; raises if the block digest
    or the payload digest of a response is wrong."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if _digest(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"wrong block digest in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response" and _digest(hashlib.sha1(payload).digest()) != fields["WARC-Payload-Digest"]:
        raise ValueError(f"wrong payload digest in {fields['WARC-Record-ID']}")
    return fields, http, payload


def write_warc(pages: DataFrame, out: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
               shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` as WARC files under ``out``; the manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    light = rows.select("id", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha1"))
    light = common.store(light, "warc-digests")
    total = light.agg(F.sum(F.col("n") + 512)).first()[0] or 0
    bounds = common.range_bounds(light, "id", max(1, -(-total // shard_bytes)))

    long = light.where(F.col("n") >= REVISIT_BYTES)
    groups = long.groupBy("sha1", "n").agg(F.max("id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1")
    revisits = long.join(groups, ["sha1", "n"]).where("NOT (id <=> refers_to)").where("refers_to IS NOT NULL")
    # a decision names the digest too, as an id can have several payloads
    decisions = revisits.select("id", "sha1", "refers_to").distinct()
    all_rows = rows.select("id", "uri", "payload", F.lit(None).cast("string").alias("sha1"), F.lit(None).cast("long").alias("refers_to")) \
        .unionByName(decisions.select("id", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("binary").alias("payload"), "sha1", "refers_to"))
    placed = all_rows.withColumn("shard", common.shard_of("id", bounds)).repartitionById(len(bounds) + 1, F.col("shard")) \
        .sortWithinPartitions("id", F.col("refers_to").asc_nulls_last(), "uri", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = common.filesystem(out)
        fs.create_dir(f"{folder}/_tmp", recursive=True)
        entry, f, known, done = None, None, (object(), {}), []
        seq = 0

        def close() -> None:
            f.close()
            done.append(entry)

        for piece in common.slices(batches, "payload", PIECE):
            for r in piece.to_pylist():
                if known[0] != r["id"]:
                    known = r["id"], {}
                if r["refers_to"] is not None:  # decisions precede the pages of their id
                    known[1][r["sha1"]] = r["refers_to"]
                    continue
                if entry is None:
                    name = f"{r['shard']:06d}-{seq:04d}.warc.gz"
                    part = f"{folder}/_tmp/{name}.{uuid.uuid4().hex}"
                    entry = {"shard": r["shard"], "seq": seq, "part": part, "path": f"{folder}/{name}", "records": 0,
                             "bytes": 0, "first_id": r["id"], "last_id": None}
                    f = fs.open_output_stream(part, compression=None)
                refers = known[1].get(hashlib.sha1(r["payload"]).hexdigest()) if known[1] else None
                data = make_record(r["id"], r["uri"] or "", r["payload"], refers)
                f.write(data)
                entry["records"] += 1
                entry["bytes"] += len(data)
                entry["last_id"] = r["id"]
                if entry["bytes"] >= file_bytes:
                    close()
                    entry, seq = None, seq + 1
        if entry:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([
                ("shard", pa.int32()), ("seq", pa.int32()), ("part", pa.string()), ("path", pa.string()),
                *[(k, pa.int64()) for k in ("records", "bytes", "first_id", "last_id")]]))

    placed.mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = common.filesystem(out)[0]
        for batch in batches:
            for r in batch.to_pylist():
                if fs.get_file_info(r["part"]).type.name != "NotFound":  # a repeated task finds it renamed
                    fs.move(r["part"], r["path"])
            yield batch

    spark.read.schema(MANIFEST).parquet(f"{out}/_manifest").mapInArrow(commit, MANIFEST).write.parquet(f"{out}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_warc(manifest: DataFrame, out: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the files that the manifest lists."""
    schema = ROW + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if x.split()[1] == "long" else pa.binary() if x.split()[1] == "binary" else pa.string() for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = common.filesystem(out)[0]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as f:
                    for raw in members(f):
                        fields, http, payload = parse_record(raw)
                        number = lambda k: int(fields[k]) if k in fields else None  # noqa: E731, B023
                        size = next(int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
                        sha1 = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                        rows.append((number("X-Page-Id"), fields["WARC-Target-URI"], fields["WARC-Type"], size, sha1,
                                     number("X-Refers-To-Page-Id"), *([payload] * with_payload)))
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 5000 or held > PIECE:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    n = max(1, manifest.agg(F.max("shard")).first()[0] or 0) + 1
    return manifest.select("shard", "path").repartitionById(n, F.col("shard")).mapInArrow(read, schema)


def archive(spark: SparkSession, pages: DataFrame, **kw) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    out = common.work_path(spark, "warc")
    return read_warc(write_warc(pages, out, **kw), out)
