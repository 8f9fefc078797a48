"""SQL text shared by the DuckDB oracle queries.

The oracle restates every registered query in plain SQL over the same parquet
views.  ``PREP`` is the fixture panel plus the same-row columns of
``functions.columns.prepare_panel``.
"""

from __future__ import annotations

from ..sources.fixture import PANEL_SQL

PREP = f"""panel as ({PANEL_SQL}),
p as (
  select *,
    cast(quali_position is null as int) as missing_qualifying,
    nullif(grid, 0) as grid_position,
    points as grand_prix_points,
    0 as sprint_points,
    coalesce(points, 0) + 0 as event_points,
    cast(season = 2001 and round in (2, 4, 5, 9, 12, 16) as int) as sprint_weekend_flag,
    cast(position_order <= 10 as int) as target_top10,
    cast(position_order <= 3 as int) as target_podium,
    cast(points as double) as target_points,
    nullif(grid, 0) - quali_position as grid_vs_quali_delta,
    cast(coalesce(quali_position <= 3, false) as int) as qualified_top3,
    cast(coalesce(quali_position <= 10, false) as int) as qualified_top10,
    cast(coalesce(nullif(grid, 0) <= 3, false) as int) as started_top3,
    cast(coalesce(nullif(grid, 0) <= 10, false) as int) as started_top10,
    round as race_round,
    cast(season >= 2001 as int) as is_2001_regulation,
    case when position_order is not null
         then cast(not regexp_matches(coalesce(status, ''), 'Finished|Lap', 'i') as int) end as is_dnf,
    position_order - nullif(grid, 0) as grid_to_finish_delta
  from panel
)"""


def with_prep(*ctes: str) -> str:
    """``with panel, p[, extra ctes]`` prefix."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"with {PREP}{extra}\n"


def rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in cols)
