"""Command line: the batch entry points of the pipeline.

    python -m tallyspark.cli build-panel --data DIR --out PATH [--mode strict|compat]
    python -m tallyspark.cli evaluate    --data DIR --out PATH [--trees N] [--artifacts DIR]
    python -m tallyspark.cli train-live  --data DIR --artifacts DIR [--round R] [--trees N]
    python -m tallyspark.cli predict     --data DIR --out PATH --round R [--top-n 10] [--artifacts DIR]

``--data`` is a directory of the supplied parquet tables.  On a cluster the
session comes from ``spark-submit``; locally a ``local[*]`` session is made.
Outputs are parquet tables (metrics also as JSON lines).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import local_session
    return local_session()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tallyspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build-panel")
    b.add_argument("--data", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--mode", default="strict", choices=["strict", "compat"])
    e = sub.add_parser("evaluate")
    e.add_argument("--data", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--trees", type=int, default=500)
    e.add_argument("--artifacts", default=None)
    t = sub.add_parser("train-live")
    t.add_argument("--data", required=True)
    t.add_argument("--artifacts", required=True)
    t.add_argument("--round", type=int, default=None)
    t.add_argument("--trees", type=int, default=500)
    p = sub.add_parser("predict")
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--round", type=int, required=True)
    p.add_argument("--top-n", type=int, default=10)
    p.add_argument("--artifacts", default=None)
    a = ap.parse_args(argv)

    spark = _session()
    from .plans.panel import feature_panel, prepared_panel
    from .sources.sinks import write_json_lines, write_table
    from .spec import DEFAULT_SPEC
    spec = DEFAULT_SPEC.with_mode(a.mode) if a.cmd == "build-panel" else DEFAULT_SPEC
    if a.cmd == "build-panel":
        from .operators.quality import assert_no_leakage
        fp = feature_panel(spark, a.data, spec)
        assert_no_leakage(fp, spec.key, spec.entity, spec.seq)
        write_table(fp, a.out, partition_by=[spec.season])
    elif a.cmd == "evaluate":
        from .operators.models import TreeParams
        from .plans.evaluate import evaluate_families
        m = evaluate_families(feature_panel(spark, a.data), TreeParams(n_trees=a.trees),
                              artifact_dir=a.artifacts)
        write_table(m, a.out)
        write_json_lines(m, a.out + "_json")
    elif a.cmd == "predict":
        from .operators.future import event_schedule
        from .plans.predict import predict_event
        prep = prepared_panel(spark, a.data)
        out = predict_event(prep, event_schedule(prep, spec), spec, spec.live_season, a.round, a.top_n,
                            artifacts=a.artifacts)
        write_table(out, a.out)
    elif a.cmd == "train-live":
        from .operators.models import TreeParams
        from .plans.artifacts import save_family, train_live_family
        for mode in ("pre_quali", "post_quali"):
            fam, thr = train_live_family(feature_panel(spark, a.data), mode, TreeParams(n_trees=a.trees), a.round)
            save_family(spark, fam, {r["task"]: r["threshold"] for r in thr.collect()}, a.artifacts, "live", mode,
                        {"season": spec.live_season, "round": a.round})


if __name__ == "__main__":
    main()
