import hashlib
import random

import numpy as np
import pytest
from helpers import repeated_bytes as plain

from tallyspark.llm import catalog, op2_suffix_dedup as op2

SCHEMA = "doc_id long, text string, row long, of string"


def check(df, rows):
    got = sorted(op2.dedup(df, with_text=True).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = plain(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want


def test_query_equals_all_strings(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in catalog.QUERIES["op2_suffix_dedup_of_documents"](spark, sf_dir).collect()}
    assert got == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(rows, plain(rows), strict=True)}


def mosaic(rng, n, alphabet="abcde fghij\né"):
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.choice([40, 99, 100, 101, 130, 300]))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(8)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            text += p[a:a + rng.choice([50, 100, 400])] if rng.random() < 0.7 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(90)))
        rows.append((i * 3 % 101, text, i, "clash"))
    return rows


@pytest.mark.parametrize("shard,many", [(1 << 20, 4096), (600, 4096), (600, 1)])
def test_mosaics_in_small_shards(spark, monkeypatch, shard, many):
    monkeypatch.setattr(op2, "SHARD", shard)
    monkeypatch.setattr(op2, "MANY", many)
    rows = mosaic(random.Random(shard + many), 90)
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), [r[:2] for r in rows])


def test_periodic_long_null_empty_and_repeated_rows(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abc ") for _ in range(1_300_000))
    rows = [(1, None, 0, ""), (2, "", 0, ""), (3, "a" * 99, 0, ""), (4, "a" * 100, 0, ""), (5, "a" * 400, 0, ""), (6, "ab" * 300, 0, ""), (7, long, 0, ""),
            (8, "x" + long[1000:3000], 0, ""), (None, "q" * 150, 0, ""), (9, "q" * 120, 0, "")]
    check(spark.createDataFrame(rows, SCHEMA).coalesce(3), [r[:2] for r in rows])
    twice = spark.createDataFrame([(1, "word " * 60, 0, ""), (2, long[:500], 0, ""), (2, long[:500], 0, "")], SCHEMA)
    assert sorted(r.n_removed for r in op2.dedup(twice).where("doc_id = 2").collect()) == [0, 500]


def test_no_rows(spark):
    assert op2.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 150, 3000, (1 << 21) + 5])
def test_suffix_array_is_sorted_to_its_depth(n):
    rng = np.random.default_rng(n)
    data = rng.integers(97, 100, n).astype(np.uint8)
    data[n // 2:n // 2 + n // 4] = data[:n // 4]
    sa, bound = op2.suffix_array(data, 100)
    assert (np.sort(sa) == np.arange(n)).all()
    raw = data.tobytes()
    for i in np.random.default_rng(0).integers(0, n, 400):
        if i:
            a, b = raw[sa[i - 1]:sa[i - 1] + 100], raw[sa[i]:sa[i] + 100]
            assert a <= b
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert bound[i] == 0 or same < bound[i]
            got = op2.common_prefixes(data, sa[[i]], sa[[i - 1]])[0]
            assert min(got, 100) == same
