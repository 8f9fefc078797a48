import random

import pytest
from helpers import duplicate_lines as plain

from tallyspark.llm import catalog, op7_line_dedup as op7

SCHEMA = "doc_id long, text string, id string, place int"


def result(df, **kw):
    return {r.doc_id: r.removed for r in op7.duplicate_lines(df, **kw).collect()}


def test_query_equals_comparing_all_lines(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalog.QUERIES["op7_line_dedup_of_documents"](spark, sf_dir).collect()
    assert {r.doc_id: r.removed for r in got} == plain(rows)
    assert all(r.n_removed == len(r.removed) for r in got)
    assert {r.doc_id: r.n_lines for r in got} == {i: len(t.split("\n")) if t else 0 for i, t in rows}


@pytest.mark.parametrize("table_words", [0, 40, 10_000])
def test_lines_around_the_threshold_with_any_word_table(spark, table_words):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(150)]
    bases = [[rng.choice(vocab) for _ in range(n)] for n in (1, 2, 4, 5, 9, 10, 25, 40, 60)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(6):
            w = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 7])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines), "clash", 0))
    assert result(spark.createDataFrame(rows, SCHEMA), table_words=table_words) == plain([r[:2] for r in rows])


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None, "", 0), (2, "", "", 0), (3, "\n \n\t", "", 0), (4, "A b\nc\n\na B", "", 0), (5, "c\nnew\n", "", 0), (6, long + " z\n" + "y" * 200_000, "", 0),
            (7, long, "", 0), (8, "same", "", 0), (8, "same", "", 0), (None, "new\nnull", "", 0)]
    got = op7.duplicate_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_lines, r.removed) for r in got} == {
        1: (0, []), 2: (0, []), 3: (3, []), 4: (4, [3]), 5: (3, [0, 1]), 6: (2, []), 7: (1, [0]), 8: (1, []), None: (2, [])}


def test_no_rows_and_texts_without_the_lines(spark):
    df = spark.createDataFrame([(1, "a b\nc", "", 0), (2, "c\nd\na b", "", 0)], SCHEMA)
    assert op7.duplicate_lines(df.limit(0)).collect() == []
    assert {r.doc_id: r.text for r in op7.without_lines(df, op7.duplicate_lines(df)).collect()} == {1: "a b\nc", 2: "d"}
