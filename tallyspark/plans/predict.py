"""Score one selected event (L11) or every future event.

future rows (as-of features) -> mode per event (P28) -> model columns
present? (P26) -> score -> top-N per event (O3) -> confidence (P25) and
its mode per event (A22) as metadata.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import confidence_label, rank_score, threshold_class
from ..operators import future as FU
from ..operators import rank as RK
from ..operators.models import score_family
from ..operators.roles import HISTORY, built_columns
from ..session import materialize
from ..spec import DEFAULT_SPEC, PanelSpec
from .artifacts import load_family


def fill_missing_columns(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add model columns absent from the input as nulls and report them."""
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in missing}), missing


def strip_engineered(df: DataFrame, keep: Sequence[str] = (), spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Drop what the feature build adds, so that it can add it again;
    keys, names and the raw inputs stay."""
    return df.drop(*[c for c in built_columns(spec) if c not in keep])


def deterministic_scores(rows: DataFrame) -> DataFrame:
    """Model-free scorer used when no artifact is supplied: recent rates as
    probabilities and recent points as expected points."""
    return rows.withColumns({
        "proba_top10": F.coalesce(F.col("driver_top10_rate_last_10"), F.lit(0.0)),
        "proba_podium": F.coalesce(F.col("driver_podium_rate_last_10"), F.lit(0.0)),
        "expected_points": F.greatest(F.coalesce(F.col("driver_points_last_5"), F.lit(0)) / 5.0, F.lit(0.0)),
    })


def finish_predictions(scored: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    t = thresholds or {}
    x = scored.withColumns({
        "race_rank_score": rank_score("expected_points", "proba_podium", "proba_top10"),
        "predicted_top10": threshold_class("proba_top10", t.get("top10", 0.5)),
        "predicted_podium": threshold_class("proba_podium", t.get("podium", 0.5)),
    })
    return x.withColumn("confidence", confidence_label("proba_top10", "race_rank_score", "prediction_mode"))


def score_with_artifacts(rows: DataFrame, root: str) -> tuple[DataFrame, dict[str, dict]]:
    """Score each row with the trained family of its prediction mode
    (live first, else evaluation); the families' documents by mode, with the
    model columns that the rows lack (P26)."""
    spark, out, docs = rows.sparkSession, None, {}
    modes = [r[0] for r in rows.select("prediction_mode").distinct().collect()]  # at most two
    for label in sorted(modes):
        mode = "post_quali" if label.upper().startswith("POST") else "pre_quali"
        fam, doc = load_family(spark, root, mode)
        part, missing = fill_missing_columns(rows.filter(F.col("prediction_mode") == label), fam.features)
        part = score_family(fam, part)
        t = doc["thresholds"]
        part = finish_predictions(part, t).withColumns({
            "model_family": F.lit(doc["family"]), "missing_features": F.lit(",".join(missing))})
        if "rank_model_score" in part.columns:
            part = part.withColumn("race_rank_score", F.coalesce("rank_model_score", "race_rank_score"))
        docs[mode] = doc | {"missing": missing}
        out = part if out is None else out.unionByName(part)
    return out, docs


def predict_event(prepared: DataFrame, schedule: DataFrame, spec: PanelSpec, season: int, round_: int,
                  top_n: int = 10, scorer=deterministic_scores, quali_feed: DataFrame | None = None,
                  artifacts: str | None = None) -> DataFrame:
    """Top-N table for one event with its metadata columns. With
    ``artifacts`` the trained families under that folder score the rows and
    their thresholds decide; else the model-free ``scorer``."""
    base = strip_engineered(prepared, keep=_prepared_columns(spec), spec=spec)
    rows = FU.future_feature_rows(base, schedule, spec, season, round_, only_round=round_, quali_feed=quali_feed)
    cols = ["season", "round", spec.entity, spec.entity_name, spec.group, "proba_top10", "proba_podium",
            "expected_points", "race_rank_score", "predicted_top10", "predicted_podium", "confidence",
            "prediction_mode"]
    if artifacts:
        rows = materialize(rows, "future_rows")
        scored, _ = score_with_artifacts(rows, artifacts)
        cols += ["model_family", "missing_features"]
    else:
        scored = finish_predictions(scorer(rows))
    entrants = rows.groupBy("season", "round").agg(F.count(F.lit(1)).alias("entrants"))
    top = RK.predict_top_n(scored.select(*cols), ["season", "round"], spec.entity, top_n)
    meta = RK.label_mode(top, ["season", "round"], "confidence", "confidence_mode")
    meta = meta.join(entrants, ["season", "round"], "left").withColumns({
        "cutoff_season": F.lit(season), "cutoff_round": F.lit(round_)})
    return top.join(meta, ["season", "round"], "left")


def _prepared_columns(spec: PanelSpec) -> list[str]:
    """Columns of ``prepare_panel``, which the history build reads."""
    return [c for c, role in built_columns(spec).items() if role != HISTORY and not c.startswith("teammate_")
            and not c.endswith("_vs_teammate")]
