"""Quality rules: counts against a plain version, order and short circuit of the cascade."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import catalog, op13_quality as op13


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len({i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}))


def texts():
    rng = random.Random(5)
    vocabulary = ["der", "Été", "a", "#x#", "b|", "naïve", "9", "…", "漢字"]
    out = [None, "", " \n\t ", "one", "one two", "a b c a b c", "x\ny\nx\n\nx \n", "\x0bw\x0cw\rw", "a\x00b a b"]
    for n in (3, 10, 60, 60, 400):
        out += ["".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(n)) for _ in range(4)]
    return [*out, "long " * 30000, out[-1]]


def test_counts_equal_a_plain_version(spark):
    rows = list(enumerate(texts()))
    got = op13.judge(spark.createDataFrame([*rows, (1, "again"), (None, "no id")], "doc_id long, text string"), op13.RULES).collect()
    assert len(got) == len(rows) + 2
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        want = counts(text)
        assert any((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want for r in by_id[i]), (i, want, by_id[i])
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in by_id[i])
        assert not any(r.kept and (r.base_failed or r.failed_rule) for r in by_id[i])


def test_equal_hashes_of_different_windows_are_told_apart(spark, monkeypatch):
    """With a poor hash (all equal) the words decide."""
    real, asked = op13.sorted_windows, []

    def poor(words, joined=None):
        asked.append(joined)
        return real(words, (lambda a, b: F.lit(1)) if joined is None else joined)
    monkeypatch.setattr(op13, "sorted_windows", poor)
    rows = [(i, t) for i, t in enumerate(texts()) if not t or len(t) < 5000]
    got = op13.judge(spark.createDataFrame(rows, "doc_id long, text string"), op13.RULES).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {i: counts(t)[4] for i, t in rows}
    assert None in asked


def test_each_rule_rejects_its_kind_and_clean_text_stays(spark):
    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)]
    clean = "\n".join(" ".join(words[i:i + 10]) for i in range(0, 100, 10))
    kinds = {
        "symbols": " ".join(w + "#" for w in words), "word length": " ".join(w * 4 for w in words),
        "repeated lines": "\n".join([*words, *["so"] * 150]), "exclamation marks": "! ".join(words), "capitals": clean.upper(),
        "digits": " ".join(f"{i}{i}{i}" + "a" for i in range(100, 180)), "words without letters": " ".join(f"{w} ;;;;;" if i % 2 else w for i, w in enumerate(words)),
        "cut lines": clean.replace("\n", "...\n") + "…", "bullet lines": "\n".join("- " + x for x in clean.split("\n")), None: clean,
    }
    names = {i: k for i, k in enumerate(kinds)}
    got = {r.doc_id: r for r in op13.judge(spark.createDataFrame(list(enumerate(kinds.values())), "doc_id long, text string"), op13.RULES, repeat_percent=100).collect()}
    assert {names[i]: r.failed_rule for i, r in got.items()} == {k: k for k in kinds}
    assert [r.kept for i, r in sorted(got.items())] == [k is None for k in kinds]


def test_later_rules_are_not_evaluated(spark):
    stop = op13.Rule("stop", lambda x: x.n_words >= 0)
    never = op13.Rule("never", lambda x: F.raise_error(F.lit("evaluated")).cast("boolean"))
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60))) for i in range(5)], "doc_id long, text string")
    assert {r.failed_rule for r in op13.judge(docs, [stop, never]).collect()} == {"stop"}
    with pytest.raises(Exception, match="evaluated"):
        op13.judge(docs, [never, stop]).collect()


def test_order_is_rejections_per_cost_among_what_is_left():
    rules = [op13.Rule(n, None) for n in "abcd"]
    # a and b reject the same 60 rows, c rejects 30 others, d none
    outcomes = [((True, True, False, False), 60), ((False, False, True, False), 30), ((False,) * 4, 10)]
    cost = {"a": 3.0, "b": 2.0, "c": 2.0, "d": 1.0}
    assert [r.name for r in op13.greedy(rules, cost, outcomes)] == ["b", "c", "d", "a"]


def test_the_order_never_changes_the_verdict(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules, cost = op13.order_by_sample(docs, passed=~op13.base_failed())
    assert {r.name for r in rules} == {r.name for r in op13.RULES} == set(cost) and min(cost.values()) > 0
    one = {(r.doc_id, r.kept) for r in op13.judge(docs, rules).collect()}
    assert one == {(r.doc_id, r.kept) for r in op13.judge(docs, rules[::-1]).collect()}


def test_good_documents_are_kept_and_bad_ones_go(spark):
    got = catalog.QUERIES["op13_quality_of_documents"](spark, "/root/testdata/sf0.01")
    r = got.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("n_words >= 50").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {x.quality: x.kept for x in r.collect()}
    assert share[1] == 1.0 and share[0] == 0.0


def test_empty_tables_nulls_and_clashing_columns(spark):
    schema = "doc_id long, text string, words int, n_words int, kept string, counts int, pairs int, kept_columns int"
    assert op13.judge(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, 1, 2, "x", 3, 4, 5), (7, "a b c", 1, 2, "x", 3, 4, 5)]
    got = op13.judge(spark.createDataFrame(rows, schema), keep=("doc_id",)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [(0, 0, False), (7, 3, False)]


def test_main_path_is_native_and_has_no_exchange(spark, sf_dir):
    plan = op13.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), op13.RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
