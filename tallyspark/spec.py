"""Panel specification: column roles and feature configuration.

The same operators run on any entity x group x venue event panel.  Column
names are parameters; engineered feature names follow the published model
schema (``driver_*`` for the entity, ``constructor_*`` for the group,
``circuit_*`` for the venue) so that trained schemas and feature selectors keep
working unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "driver_id"
    entity_name: str = "driver_name"
    group: str = "constructor_id"
    venue: str = "circuit_id"
    season: str = "season"
    round: str = "round"
    # integer, strictly increasing with (date, round); one value per event
    seq: str = "event_seq"
    finish: str = "position_order"
    grid: str = "grid"
    quali: str = "quali_position"
    status: str = "status"
    points: str = "points"
    windows: tuple[int, ...] = (3, 5, 10)
    rate_windows: tuple[int, ...] = (5, 10)
    live_season: int = 2001
    # Calendar rounds of the live season that carry a sprint.
    sprint_rounds: tuple[int, ...] = (2, 4, 5, 9, 12, 16)
    # "strict": nothing of the current event is visible to any history
    # feature; "compat": reproduce the row-level shift of the original
    # pipeline (later rows of the same event see earlier rows).
    mode: str = "strict"

    @property
    def event(self) -> list[str]:
        return [self.season, self.round]

    @property
    def key(self) -> list[str]:
        return [self.season, self.round, self.entity]

    def with_mode(self, mode: str) -> "PanelSpec":
        if mode not in ("strict", "compat"):
            raise ValueError("mode must be 'strict' or 'compat'")
        return replace(self, mode=mode)


@dataclass(frozen=True)
class SplitSpec:
    """Chronological split of seasons (train range, validation, test, live)."""

    train_seasons: tuple[int, int] = (1995, 1998)
    validation_season: int = 1999
    test_season: int = 2000
    live_season: int = 2001
    # season upper bound -> weight, checked in order; seasons above the
    # last bound get ``live_weight``.  Fixed values of the weighting scheme.
    weight_steps: tuple[tuple[int, float], ...] = field(
        default=((1996, 0.5), (1998, 0.8), (2000, 1.0)))
    live_weight: float = 2.0


DEFAULT_SPEC = PanelSpec()
DEFAULT_SPLIT = SplitSpec()
