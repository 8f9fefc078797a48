"""Each stage of the pipeline against a plain version of its decision."""
import random

import pytest
from helpers import near_duplicates

import corpus_pipeline as pipeline
from tallyspark.llm import common


def test_stages_keep_columns_and_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spoilt = docs.limit(3).selectExpr("doc_id + 100000 AS doc_id", "'123 456' AS text", "lang", "source", "n_chars")
    docs = common.store(docs.unionByName(spoilt), "pipeline-test")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = common.store(stage(spark, docs, sf_dir), "pipeline-test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        after = {r.doc_id: r.text for r in docs.collect()}
        assert all(before[i] == t for i, t in after.items()), name
        if name == "language ID":
            assert set(before) - set(after) == {i for i in before if i >= 100000}
        elif name == "MinHash near-dedup":
            assert set(after) == {i for i, (_, c) in near_duplicates(before.items(), 5).items() if i == c}
        elif name == "benchmark decontamination":
            items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            leaks = {i for i, t in before.items() if any(x in " ".join(t.lower().split()) for x in items)}
            assert leaks <= set(before) - set(after) and len(after) >= 0.9 * (len(before) - len(leaks))
        else:
            rows = docs.groupBy("doc_id").count().collect()
            assert max(r["count"] for r in rows) <= 3 and len(after) > len(before) / 3
        before = after
    out = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == docs.count()


WORDS = [f"{a}{b}" for a in ("the", "and", "of", "to", "was", "with", "for", "that") for b in ("", "re", "ing", "ed", "ly", "er", "est", "tion")]


def text(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def stage(spark, name, rows, sf_dir, extra=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)
    out = dict(pipeline.STAGES)[name](spark, docs, sf_dir)
    if name != "token-ID / binary output":
        assert out.columns == docs.columns
    return [tuple(r) for r in out.collect()]


def test_rows_that_share_an_id_are_judged_one_by_one(spark, sf_dir):
    a, b, c, d = (text(i) for i in range(4))
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [(1, a, "en", "s", 0), (5, a, "en", "s", 0), (5, b, "en", "s", 0), (7, c, "en", "s", 0), (7, d, "en", "s", 0), (None, a, "en", "s", 0), (None, text(9), "en", "s", 0),
            (None, None, "en", "s", 0), (8, None, "en", None, 0), (8, "", None, "s", 0)]
    kept = stage(spark, "MinHash near-dedup", rows, sf_dir)
    assert sorted(map(str, kept)) == sorted(str(r) for r in rows if (r[0], r[1]) not in ((5, a), (None, a)))
    hit = [(3, b + " " + leak, "en", "s", 0), (3, a, "en", "s", 0), (None, leak, "en", "s", 0), (None, c, "en", "s", 0)]
    assert sorted(map(str, stage(spark, "benchmark decontamination", hit, sf_dir))) == sorted(map(str, [hit[1], hit[3]]))
    mixed = stage(spark, "mixing sources to target weights", rows, sf_dir)
    assert set(mixed) <= set(rows) and len(mixed) >= 5 and not [r for r in mixed if not r[1]]


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_empty_tables_nulls_and_clashing_columns(spark, sf_dir, name):
    assert stage(spark, name, [], sf_dir) == []
    nulls = [(None, None, None, None, None), (None, None, None, None, None), (1, None, None, None, None)]
    assert len(stage(spark, name, nulls, sf_dir)) in (0, 3)
    extra = ", copies int, copy int, `of` int, gone long, number long, row string, kept string, component_id long, id long"
    rows = [(i, text(i), "en", f"s{i % 2}", 0, 1, 2, 3, 4, 5, "x", "y", 6, 7) for i in range(6)]
    out = stage(spark, name, rows, sf_dir, extra)
    assert len(out) >= 3 and (name == "token-ID / binary output" or set(out) <= set(rows))
