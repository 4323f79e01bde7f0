"""What a panel is: many entities, each with an ordered history of measurements."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PanelSpec:
    """Names the columns of a panel; operators never address columns by position.

    ``order`` must be a total, non-null order of the rows inside one entity, so its last
    column is usually a unique tie-breaker. ``max_history`` is an upper bound on the rows of any
    entity, if one is known; it saves looking for entities too long for one task.
    """

    entity: str
    order: tuple[str, ...]
    features: tuple[str, ...]
    label: str | None = None
    max_history: int | None = None

    def __post_init__(self):
        if not self.order:
            raise ValueError("a panel needs at least one order column")
        clash = {self.entity, *self.order, self.label} & set(self.features)
        if clash:
            raise ValueError(f"features may not contain key, order or label columns: {sorted(clash)}")

    @property
    def keys(self) -> list[str]:
        """Columns that identify one row."""
        return [self.entity, *self.order]

    def without(self, *names: str) -> "PanelSpec":
        return replace(self, features=tuple(c for c in self.features if c not in names))

    def with_features(self, *names: str) -> "PanelSpec":
        return replace(self, features=tuple(names))

    def bounded(self, rows: int) -> "PanelSpec":
        """The spec of a panel whose entities are known to have at most ``rows`` rows, as after a trim."""
        return replace(self, max_history=rows)

    def encoded(self, column: str, indicators: list[str], position: str = "in_place") -> "PanelSpec":
        """The spec after ``column`` was replaced by its indicator columns."""
        if position == "end" or column not in self.features:
            kept = [c for c in self.features if c != column]
            return self.with_features(*kept, *indicators)
        out: list[str] = []
        for c in self.features:
            out.extend(indicators if c == column else [c])
        return self.with_features(*out)
