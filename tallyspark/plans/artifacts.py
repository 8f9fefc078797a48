"""Trained families on disk (S13): everything that scoring needs, reloadable
from a new session.

Each save writes a new version folder ``root/{live|evaluation}/{mode}/v-*``
(models and one JSON document: feature columns, medians, rankers, thresholds
and where the training rows end) and then replaces the one small file
``root/{family}/{mode}/current`` that names it. A save that dies halfway leaves
the family as it was; a reader sees one version whole. Boosted models are part
of the document, ``pyspark.ml`` models lie beside it.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import models as ML
from ..operators import split as SL
from ..session import hadoop_path, read_file, replace_file
from ..sources.sinks import load_model, load_small_json, save_model, save_small_json
from ..spec import DEFAULT_SPLIT, SplitSpec

FAMILIES = ("live", "evaluation")
VERSION = 2


def _ranker_document(r: ML.PairwiseRanker | None) -> dict | None:
    return r and {"weights": r.weights.tolist(), "event": r.event}


def write_version(spark: SparkSession, fam: ML.Family, thresholds: dict[str, float], root: str, family: str, mode: str,
                  trained_to: dict[str, int | None]) -> str:
    """A version's folder, not yet published; its path below ``root``."""
    name = f"v-{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{family}/{mode}"
    boosted = {t: m.document() for t, m in fam.models.items() if isinstance(m, B.Ensemble)}
    for task, model in fam.models.items():
        if task not in boosted:
            save_model(model, path, name, task)
    if isinstance(fam.ranker, B.Ensemble):
        boosted["rank"] = fam.ranker.document()
    linear = fam.ranker if isinstance(fam.ranker, ML.PairwiseRanker) else fam.linear
    save_small_json(spark, {"version": VERSION, "family": family, "mode": mode, "features": fam.features,
                            "medians": fam.imputer.values(), "boosted": boosted, "ranker": _ranker_document(linear),
                            "thresholds": thresholds, "trained_to": trained_to}, f"{path}/{name}/family")
    return f"{path}/{name}"


def publish_version(spark: SparkSession, version: str) -> None:
    """Make a written version the one that readers load."""
    folder, name = version.rsplit("/", 1)
    replace_file(spark, f"{folder}/current", json.dumps({"version": name}))


def save_family(spark: SparkSession, fam: ML.Family, thresholds: dict[str, float], root: str, family: str, mode: str,
                trained_to: dict[str, int | None]) -> str:
    version = write_version(spark, fam, thresholds, root, family, mode, trained_to)
    publish_version(spark, version)
    return version


def drop_old_versions(spark: SparkSession, root: str, family: str, mode: str) -> int:
    """Delete the versions that are not current (unfinished saves too); call
    it when no reader is on one of them. Returns their number."""
    path = f"{root.rstrip('/')}/{family}/{mode}"
    text = read_file(spark, f"{path}/current")
    if text is None:
        return 0
    keep, gone = json.loads(text)["version"], 0
    fs, p = hadoop_path(spark, path)
    for s in fs.listStatus(p):
        if s.isDirectory() and s.getPath().getName().startswith("v-") and s.getPath().getName() != keep:
            gone += fs.delete(s.getPath(), True)
    return gone


def load_family(spark: SparkSession, root: str, mode: str, families: tuple[str, ...] = FAMILIES) -> tuple[ML.Family, dict]:
    """The first family that was published for ``mode`` (live before
    evaluation) and its document."""
    for family in families:
        path = f"{root.rstrip('/')}/{family}/{mode}"
        text = read_file(spark, f"{path}/current")
        if text is None:
            continue
        name = json.loads(text)["version"]
        doc = load_small_json(spark, f"{path}/{name}/family")
        if doc["version"] != VERSION:
            raise ValueError(f"artifacts of version {doc['version']} under {root}; this is version {VERSION}")
        boosted = {t: B.Ensemble.of(d) for t, d in doc["boosted"].items()}
        models = {t: boosted[t] if t in boosted else load_model(spark, path, t, [name]) for t in ("top10", "podium", "points")}
        linear = doc["ranker"] and ML.PairwiseRanker(doc["features"], np.array(doc["ranker"]["weights"]), event=doc["ranker"]["event"])
        imputer = SL.MedianImputer.of(spark, doc["medians"], doc["features"])
        if "rank" in boosted:
            return ML.Family(doc["features"], imputer, models, boosted["rank"], linear or None), doc
        return ML.Family(doc["features"], imputer, models, linear), doc
    raise FileNotFoundError(f"no {mode} family under {root} in {', '.join(families)}")


def train_live_family(panel: DataFrame, mode: str, params: ML.TreeParams, cutoff_round: int | None,
                      sp: SplitSpec = DEFAULT_SPLIT) -> tuple[ML.Family, DataFrame]:
    """L2 + L8: a family on all closed seasons and the live season up to the
    cutoff round, and its F1 thresholds on the validation season."""
    from .evaluate import tuned_thresholds
    lab = SL.split_label(panel, sp).withColumn("weight", SL.season_weight(sp))
    feats = [c for c in SL.numeric_feature_columns(lab, mode) if c != "season"]
    fam = ML.train_family(SL.live_training_rows(lab, sp, cutoff_round), feats, params)  # no season is held out, so all trees are grown
    scored = ML.score_family(fam, lab.filter(F.col("split") == "validation"))
    return fam, tuned_thresholds(scored)
