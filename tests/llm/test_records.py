"""WARC archives and token records: round trips, determinism and recovery."""
import glob
import gzip
import hashlib
import io
import os
import random
import struct
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tallyspark.llm import catalog, common, op1_warc as op1, op3_token_records as op3

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def encode(text):
    return [*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, 2]


def expected(rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(encode(text), "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_query_equals_plain_encoding(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalog.QUERIES["op3_token_records_of_documents"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_texts_that_are_hard_to_split(spark):
    rng = random.Random(2)
    bits = ["don't", "we'll", "'s's", "ÉCOLE", "école", "ß", "İ", "I\u0307", "e\u0301", "naïve,", "a\u00a0b", "a\u2003b", "x\x0by", "x\x1cy", "<|endoftext|>", "<|ENDOFTEXT|>",
            "ab<|startoftext|>c", "$$$", "a.b", "word...", "12,5", "½", "日本語", "🙂👍", "\x00", "Ω", "ΑΣ", "\u00ad", "à\u00ad", "æøå", "×÷", "_a_"]
    rows = [(i, rng.choice([" ", "\n", "\t ", ""]).join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(250)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "y" * 50_000), (904, "long word " * 40_000), (None, "null id"), (905, "twice"), (905, "twice"), (-7, "first")]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, path string, base int").repartition(5)
    out = common.work_path(spark, "t")
    manifest = op3.write_shards(df, out, TOKENIZER, 2, shard_bytes=100_000)
    assert manifest.count() > 3
    got = [tuple(r) for r in op3.read_records(manifest, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    ids = {r.start: r.ids for r in op3.read_records(manifest, out, with_tokens=True).collect()}
    assert all(zlib.crc32(np.array(ids[s], "<u4").tobytes()) == c for _, s, _, c in got)


def test_index_finds_records_and_reruns_write_equal_files(spark):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 9)) for i in range(300)], "doc_id long, text string")
    runs = []
    for n in (2, 9):
        out = common.work_path(spark, "t")
        op3.write_shards(df.repartition(n), out, TOKENIZER, 2, shard_bytes=4000)
        files = sorted(glob.glob(f"{out}/tokens-*"))
        runs.append({os.path.basename(f): open(f, "rb").read() for f in files})
        assert not os.listdir(f"{out}/_tmp")
    assert runs[0] == runs[1] and len(runs[0]) > 4
    name = sorted(n for n in runs[0] if n.endswith(".idx"))[1]
    index = np.frombuffer(runs[0][name], "<u8").reshape(-1, 2)
    data = runs[0][name.replace(".idx", ".rec")]
    offset, size = index[-1].tolist()
    frame = data[offset:offset + size]
    length, crc = struct.unpack_from("<QI", frame)
    assert length == size - 16 and crc == op3.masked_crc(frame[:8])
    key, ids = op3.record_tokens(frame[12:-4])
    assert ids.tolist() == encode(f"text {key} " * (key % 9))


def test_a_changed_byte_is_found(spark):
    out = common.work_path(spark, "t")
    manifest = op3.write_shards(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), out, TOKENIZER, 2)
    path = glob.glob(f"{out}/tokens-*.rec")[0]
    data = bytearray(open(path, "rb").read())
    assert manifest.count() == 1 and len(list(op3.read_frames(io.BytesIO(data), path))) == 1
    for at in (0, -6):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            list(op3.read_frames(io.BytesIO(broken), path))


def test_no_documents(spark):
    assert op3.token_records(spark, spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).collect() == []


SCHEMA = "page_id long, url string, html string, shard int, refers_to long"


def archive(spark, rows, **kw):
    out = common.work_path(spark, "w")
    manifest = op1.write_warc(spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA).repartition(4), out, **kw)
    return out, op1.read_warc(manifest, out, with_payload=True).collect()


def test_archives_hold_every_page(spark):
    big, other = "x" * 1200 + "é", "z" * 999
    rows = [(3, "http://a/\n1", big), (9, None, big), (5, "u", big), (1, "u", other), (2, "u", other), (4, "u", None), (6, "u", ""), (None, "u", big),
            (7, "u", "w" * 2000), (7, "u", "w" * 2000), (8, "u", "k" * 3_000_000), (11, "v", "w" * 2000), (11, "v", "short")]
    out, got = archive(spark, rows, shard_bytes=2000, file_bytes=300)
    assert len(got) == len(rows)
    assert sorted((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to or -1) for r in got) == sorted(
        (i or -1, len((h or "").encode()), *(("revisit", t) if t else ("response", -1))) for (i, _, h), t in zip(
            rows, [9, None, 9, None, None, None, None, 9, 11, 11, None, None, None], strict=True))
    html = {(i, hashlib.sha1((h or "").encode()).hexdigest()): h or "" for i, _, h in rows}
    for r in got:
        text = html[r.page_id, r.payload_digest]
        assert r.payload_bytes == len(text.encode()) and bytes(r.payload).decode() == (text if r.record_type == "response" else "")
    files = sorted(glob.glob(f"{out}/*.warc.gz"))
    assert len(files) > 3 and not os.listdir(f"{out}/_tmp")
    assert all(gzip.open(f).read().startswith(b"WARC/1.1\r\nWARC-Type: ") for f in files)


def test_files_are_the_same_on_every_run_and_roll_by_size(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * (1 + i % 300)) for i in range(400)]
    runs = []
    for _ in range(2):
        random.shuffle(rows)
        out, got = archive(spark, rows, shard_bytes=100_000, file_bytes=20_000)
        runs.append({os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{out}/*.warc.gz")})
    assert runs[0] == runs[1] and len(got) == 400
    assert max(map(len, runs[0].values())) < 23_000


def test_no_pages(spark):
    assert archive(spark, [])[1] == []
