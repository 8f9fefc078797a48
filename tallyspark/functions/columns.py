"""Column expressions (P2, P4-P13, P22-P25): built-in functions only.

Every helper returns a ``Column`` or a ``DataFrame -> DataFrame`` transform
usable with ``df.transform``; nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec

# Status text that counts as a classified finish (case-insensitive).
FINISHED_PATTERN = "(?i)Finished|Lap"


def full_name(first: str, last: str) -> Column:
    """trim(coalesce(first,'') || ' ' || coalesce(last,''))."""
    return F.trim(F.concat_ws(" ", F.coalesce(F.col(first), F.lit("")),
                              F.coalesce(F.col(last), F.lit(""))))


def coerce_numeric(c: str, to: str = "double") -> Column:
    """to_numeric(errors='coerce'): unparsable values become null."""
    return F.expr(f"try_cast(`{c}` as {to})")


def coerce_date(c: str) -> Column:
    return F.expr(f"try_to_date(cast(`{c}` as string))")


def le_or_zero(c: Column, n: int) -> Column:
    """Threshold flag where a null compares as 0 (not null)."""
    return F.coalesce(c <= F.lit(n), F.lit(False)).cast("int")


def is_dnf(finish: Column, status: Column) -> Column:
    """Null when the result is unknown, else status does not match
    Finished/Lap (a null status counts as not finished)."""
    return F.when(finish.isNotNull(),
                  (~F.coalesce(status, F.lit("")).rlike(FINISHED_PATTERN)).cast("int"))


def coerce_types(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Numbers that arrive as text become numbers, text that is no number
    becomes null; columns that are numeric already stay as they are."""
    numbers = {spec.season: "int", spec.round: "int", spec.grid: "int", spec.quali: "int", spec.finish: "int",
               spec.points: "double"}
    text = {f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")}
    return df.withColumns({c: coerce_numeric(c, to) for c, to in numbers.items() if c in text})


def start_columns(spec: PanelSpec) -> dict[str, Column]:
    """What is known once the starting order is."""
    return {
        "missing_qualifying": F.col(spec.quali).isNull().cast("int"),
        "grid_position": F.nullif(F.col(spec.grid), F.lit(0)),
    }


def start_flags(spec: PanelSpec) -> dict[str, Column]:
    """Deltas and thresholds of the starting order."""
    grid_pos, quali = F.col("grid_position"), F.col(spec.quali)
    return {
        "grid_vs_quali_delta": grid_pos - quali,
        **{f"qualified_top{n}": le_or_zero(quali, n) for n in (3, 10)},
        **{f"started_top{n}": le_or_zero(grid_pos, n) for n in (3, 10)},
    }


def calendar_columns(spec: PanelSpec) -> dict[str, Column]:
    """What the calendar alone says about an event."""
    return {
        "sprint_weekend_flag": ((F.col(spec.season) == spec.live_season)
                                & F.col(spec.round).isin(list(spec.sprint_rounds))).cast("int"),
        "race_round": F.col(spec.round),
        f"is_{spec.live_season}_regulation": (F.col(spec.season) >= spec.live_season).cast("int"),
    }


def target_columns(spec: PanelSpec) -> dict[str, Column]:
    """Targets; SQL null propagation keeps unknown results null."""
    fin = F.col(spec.finish)
    return {
        "target_top10": (fin <= 10).cast("int"),
        "target_podium": (fin <= 3).cast("int"),
        "target_points": F.col(spec.points).cast("double"),
    }


def clean_base(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Coerced types, missing-qualifying flag, grid 0 -> null."""
    df = coerce_types(df, spec)
    return df.withColumns(start_columns(spec))


def add_targets(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumns(target_columns(spec))


def add_points_split(df: DataFrame, spec: PanelSpec,
                     sprint_points: str | None = None) -> DataFrame:
    """Race points, sprint points (optional input, else 0), null-safe
    event total and the calendar sprint flag."""
    sprint = F.col(sprint_points) if sprint_points else F.lit(0)
    return df.withColumns({
        "grand_prix_points": F.col(spec.points),
        "sprint_points": sprint,
    }).withColumns({
        "event_points": F.coalesce("grand_prix_points", F.lit(0)) + F.coalesce("sprint_points", F.lit(0)),
    })


def add_row_flags(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Deltas, threshold flags, race_round, regulation and DNF flags."""
    return df.withColumns({
        **start_flags(spec), **calendar_columns(spec),
        "is_dnf": is_dnf(F.col(spec.finish), F.col(spec.status)),
        "grid_to_finish_delta": F.col(spec.finish) - F.col("grid_position"),
    })


def prepare_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Base table -> cleaned table with targets and same-row flags."""
    return (df.transform(lambda d: clean_base(d, spec))
              .transform(lambda d: add_points_split(d, spec))
              .transform(lambda d: add_targets(d, spec))
              .transform(lambda d: add_row_flags(d, spec)))


def threshold_class(proba: str, threshold: float = 0.5) -> Column:
    """P22."""
    return (F.col(proba) >= F.lit(threshold)).cast("int")


def clip_min_zero(c: str) -> Column:
    """P23."""
    return F.greatest(F.col(c), F.lit(0.0))


def rank_score(points: str, p_podium: str, p_top10: str) -> Column:
    """Composite fallback score points*1 + p_podium*3 + p_top10."""
    return F.col(points) * 1.0 + F.col(p_podium) * 3.0 + F.col(p_top10)


def confidence_label(proba: str, score: str, mode: str) -> Column:
    """P25: base .55 (pre) / .75 (post), +.10 if p<.25 or p>.75, -.10 when the
    score is null; >=.80 High, >=.60 Medium, else Low.  Integer hundredths
    avoid the .55+.1 float edge."""
    base = F.when(F.upper(F.col(mode)).like("POST%"), F.lit(75)).otherwise(F.lit(55))
    p = F.col(proba)
    sure = F.when((p < 0.25) | (p > 0.75), F.lit(10)).otherwise(F.lit(0))
    miss = F.when(F.col(score).isNull(), F.lit(-10)).otherwise(F.lit(0))
    c = base + sure + miss
    return F.when(c >= 80, "High").when(c >= 60, "Medium").otherwise("Low")


def percent_string(c: str, digits: int = 1) -> Column:
    """Display formatting."""
    return F.format_string(f"%.{digits}f%%", F.col(c) * 100.0)


def null_columns(df: DataFrame, cols: Iterable[str], type_name: str = "double") -> DataFrame:
    """Add (or overwrite) columns with typed nulls."""
    return df.withColumns({c: F.lit(None).cast(type_name) for c in cols})
