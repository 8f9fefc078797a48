import random

import numpy as np
import pytest
from helpers import near_duplicates as plain
from pyspark.sql import functions as F

from tallyspark.llm import catalog, graph, op10_hyperminhash as op10, textnp

SCHEMA = "doc_id long, text string, n long, regs string"


def result(df, n=4):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in op10.near_duplicates(df, words=n).collect()}


def test_query_equals_comparing_all_sets(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalog.QUERIES["op10_near_duplicates"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("seed", range(2))
def test_groups_of_edited_copies_around_the_threshold(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 20, 60, 200]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, " ".join(w), 1, "clash"))
            i += 1
    assert result(spark.createDataFrame(rows, SCHEMA)) == plain([r[:2] for r in rows], 4)


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None, 1, ""), (2, "", 1, ""), (3, " \t\n", 1, ""), (4, "One two", 1, ""), (5, "one TWO", 1, ""), (6, "one", 1, ""),
            (7, long, 1, ""), (8, long + " tail", 1, ""), (9, "y" * 300_000, 1, ""), (9, "y" * 300_000, 1, ""), (None, "one two", 1, ""), (None, None, None, None)]
    got = op10.near_duplicates(spark.createDataFrame(rows, SCHEMA), words=4).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(rows)
    assert [by[i].component_id for i in range(1, 10)] == [1, 2, 3, 4, 4, 6, 7, 7, 9]
    assert [by[i].n_shingles for i in range(1, 7)] == [0, 0, 0, 1, 1, 1]
    assert sorted((r.component_id is None, r.kept) for r in got if r.doc_id is None) == [(False, False), (True, True)]


def test_no_rows(spark):
    assert op10.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_open_buckets_are_searched_in_cells(spark, monkeypatch):
    """Components that pivots alone don't join are found in cells of any size."""
    monkeypatch.setattr(op10, "CELL", 3)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):  # a chain: neighbours are near, ends are far apart
        base[rng.randrange(120)] = f"n{i}"
        rows.append((100 - i, " ".join(base), 1, ""))
    assert result(spark.createDataFrame(rows, SCHEMA)) == plain([r[:2] for r in rows], 4)


@pytest.mark.parametrize("kind", ["registers", "fine_registers"])
def test_registers_keep_pairs_at_the_threshold_and_drop_far_ones(kind):
    rng = np.random.default_rng(1)
    make, chance = getattr(op10, kind), {"registers": op10.CHANCE, "fine_registers": 1 / 255}[kind]
    kept = {0.8: [], 0.4: []}
    for share in kept:
        for size in (5, 20, 130, 1000, 20_000):
            for _ in range(40):
                same = round(size * 2 * share / (1 + share))
                both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64) for n in (same, size - same, size - same))
                x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
                n = np.array([float(size)])
                kept[share].append(op10.within_reach(make(x)[None], make(y)[None], n, n, chance)[0])
    assert all(kept[0.8]) and np.mean(kept[0.4]) < 0.3


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 120)] + [(200, 201), (201, 200)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in range(100, 120)} == {100} and got[201] == 200


def test_word_hashes_are_those_of_the_words_alone():
    import pyarrow as pa
    texts = ["Ab c", None, "", "ab\x0bC " + "z" * 70, "é É", "z" * 70]
    w = textnp.words(pa.array(texts))
    assert w.first.tolist() == [0, 2, 2, 2, 5, 7, 8]
    h = w.hash
    assert h[0] == h[2] and h[1] == h[3] and h[4] == h[7] and h[5] != h[6]
