"""Token-ID output: length-delimited binary records with masked checksums.

Documents are range-sorted by id into shards whose bounds depend on the ids
alone. Each task encodes its shard and writes one file of records

    length u64 | masked crc32 of the length u32 | payload | masked crc32 of the payload u32

where the payload is the id (i64), a null mark (u8), the width of a token id
(u8: 2 or 4 bytes) and the token ids, all little-endian, and a separate index
file of (offset, length) pairs for shuffled reads. Files are written under a
name of the attempt and renamed by a second job that reads the committed
manifest, so a lost or repeated task leaves no half file behind.

Encoding: the tokenizer splits at white space before anything else, so a text
is encoded word by word and each distinct word of a slice only once. Words of
ASCII letters, with or without a tail of ASCII punctuation, go straight to the BPE
model, as the normaliser and the splitter leave them as they are (Latin-1
letters too, lower-cased and written as bytes); every other word goes through
the whole tokenizer. ``tests/llm`` compares with plain
``encode`` calls.

Defined cases: a null text counts as empty (one end id); null ids come first;
rows with equal ids are all written, ordered by text. No rows: no shard, an
empty result.
"""
from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, textnp

SHARD_BYTES = 32 << 20
SLICE_BYTES = 4 << 20
MANIFEST = "shard int, part string, path string, index_path string, records long, n_tokens long"
_HEAD, _BODY = "<QI", "<qBB"
#: Words that are known by heart in a task; later ones are encoded in each slice that has them.
CACHED_WORDS = 60_000
_PLAIN = re.compile(r"([a-zà-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_LATIN_LOWER = {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}
#: How byte-level BPE writes the bytes of UTF-8 that are no printable Latin-1 character.
_BYTE_CHAR = {b: 289 + b - 127 for b in range(127, 161)} | {173: 323}


def masked_crc(data: bytes) -> int:
    """CRC-32 rotated by 15 bits plus a constant, so that a checksum of data
    that holds checksums stays meaningful."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


class WordEncoder:
    """Token ids of whole texts with a tokenizer that splits at white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tails: dict[str, list[int]] = {"": []}
        self.known: dict[str, list[int]] = {}

    def word(self, text: str) -> list[int] | None:
        """Ids of a plain word, None for one that needs the whole tokenizer."""
        if not text.isascii():
            text = text.translate(_LATIN_LOWER)
        m = _PLAIN.fullmatch(text)
        if m is None:
            return None
        stem = m[1] if m[1].isascii() else m[1].encode().decode("latin-1").translate(_BYTE_CHAR)
        ids = [t.id for t in self.tokenizer.model.tokenize(stem)]
        if m[2] not in self.tails:
            self.tails[m[2]] = self.tokenizer.encode(m[2], add_special_tokens=False).ids
        return ids + self.tails[m[2]]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts and the offset of each text's."""
        # special tokens are told apart by case
        words, first = textnp.split(column, lower=not pc.any(pc.match_substring(column, "<|")).as_py())
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        ids = [known.get(w) or self.word(w) for w in distinct]
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([distinct[i] for i in rest], add_special_tokens=False),
                        strict=True):
            ids[i] = e.ids
        if len(known) < CACHED_WORDS:
            known.update(zip(distinct, ids, strict=True))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.array(list(chain.from_iterable(ids)), np.uint32)
        at = np.concatenate([[0], np.cumsum(size)])
        index = coded.indices.to_numpy(zero_copy_only=False)
        n = size[index]
        upto = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat(at[index] - upto[:-1], n) + np.arange(upto[-1])
        return flat[where], upto[first]


def write_shards(docs: DataFrame, out: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the record and index files under ``out``; the manifest."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    bounds = common.range_bounds(rows, "id", shards)
    placed = rows.withColumn("shard", common.shard_of("id", bounds))
    placed = placed.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, fs, opened = WordEncoder(tokenizer), *common.filesystem(out)[:1], None
        folder = common.filesystem(out)[1]
        offset = records = tokens = 0
        for piece in common.slices(batches, "text", SLICE_BYTES):
            if opened is None:
                shard = piece.column("shard")[0].as_py()
                part = f"{folder}/_tmp/{shard:06d}-{uuid.uuid4().hex}"
                fs.create_dir(f"{folder}/_tmp", recursive=True)
                opened = fs.open_output_stream(part), fs.open_output_stream(part + ".index")
            ids, at = encoder.encode(piece.column("text"))
            keys = piece.column("id").to_pylist()
            data, index = [], np.zeros((len(keys), 2), "<u8")
            for i, key in enumerate(keys):
                own = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id))
                width = 2 if int(own.max()) < 1 << 16 else 4
                body = struct.pack(_BODY, key or 0, key is None, width) + own.astype(f"<u{width}").tobytes()
                size = struct.pack("<Q", len(body))
                frame = size + struct.pack("<I", masked_crc(size)) + body + struct.pack("<I", masked_crc(body))
                data.append(frame)
                index[i] = offset, len(frame)
                offset += len(frame)
                tokens += len(own)
            records += len(keys)
            opened[0].write(b"".join(data))
            opened[1].write(index.tobytes())
        if opened:
            for f in opened:
                f.close()
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "part": part, "path": f"{folder}/tokens-{shard:06d}.rec",
                "index_path": f"{folder}/tokens-{shard:06d}.idx", "records": records, "n_tokens": tokens}],
                schema=pa.schema([("shard", pa.int32()), ("part", pa.string()), ("path", pa.string()),
                                  ("index_path", pa.string()), ("records", pa.int64()), ("n_tokens", pa.int64())]))

    placed.mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{out}/_manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = common.filesystem(out)[0]
        for batch in batches:
            for r in batch.to_pylist():
                for tmp, final in ((r["part"], r["path"]), (r["part"] + ".index", r["index_path"])):
                    if fs.get_file_info(tmp).type.name != "NotFound":  # a repeated task finds it renamed
                        fs.move(tmp, final)
            yield batch

    final = manifest.mapInArrow(commit, MANIFEST)
    final.write.parquet(f"{out}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_frames(stream, what: str) -> Iterator[bytes]:
    """Payloads of a record file; raises if a length or checksum is wrong."""
    while head := stream.read(struct.calcsize(_HEAD)):
        size, crc = struct.unpack(_HEAD, head)
        if masked_crc(head[:8]) != crc:
            raise ValueError(f"{what}: wrong checksum of a length")
        body = stream.read(size)
        if len(body) != size or masked_crc(body) != struct.unpack("<I", stream.read(4))[0]:
            raise ValueError(f"{what}: wrong checksum of a record")
        yield body


def record_tokens(body: bytes) -> tuple[int | None, np.ndarray]:
    key, null, width = struct.unpack_from(_BODY, body)
    return None if null else key, np.frombuffer(body, f"<u{width}", offset=struct.calcsize(_BODY)).astype("<u4")


def read_records(manifest: DataFrame, out: str, id_col: str = "doc_id", with_tokens: bool = False) -> DataFrame:
    """One row per record, read from the files: id, start, n_tokens,
    ids_crc32 and, if asked for, the ids."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    parts = manifest.select("shard", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = common.filesystem(out)[0]
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                rows: list[tuple] = []
                with fs.open_input_stream(path, buffer_size=1 << 20) as f:
                    for body in read_frames(f, path):
                        key, ids = record_tokens(body)
                        rows.append((key, start, len(ids), zlib.crc32(ids.tobytes()), *([ids.tolist()] * with_tokens)))
                        start += len(ids)
                        if len(rows) >= (200 if with_tokens else 20_000):
                            yield _batch(rows, id_col)
                            rows = []
                if rows:
                    yield _batch(rows, id_col)

    n = max(1, manifest.count())
    return parts.repartitionById(n, F.col("shard")).mapInArrow(read, schema)


def _batch(rows: list[tuple], id_col: str) -> pa.RecordBatch:
    names = [id_col, "start", "n_tokens", "ids_crc32", "ids"][:len(rows[0])]
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)],
                                      names)


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, **kw) -> DataFrame:
    """Write ``docs`` and read them back."""
    out = common.work_path(spark, "tokens")
    return read_records(write_shards(docs, out, tokenizer, end_id, **kw), out)
