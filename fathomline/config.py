"""Job parameters. Every operator takes a ``Params``; the defaults are the published thresholds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

Box = tuple[float, float, float, float]


# The study area and thresholds that published results depend on.
@dataclass(frozen=True)
class Params:
    #: min_lon, min_lat, max_lon, max_lat; all four sides inclusive
    bbox: Box = (-6.0, 30.0, 36.5, 46.0)
    #: parts of the bbox that belong to other seas: Atlantic, Bay of Biscay, Black Sea
    exclude_boxes: tuple[Box, ...] = (
        (-6.0, 30.0, -5.62, 46.0),
        (-6.0, 42.0, 1.0, 46.0),
        (27.3, 41.15, 36.5, 46.0),
    )
    speed_kn_max: float = 1.0
    buffer_m: float = 20.0
    large_length_m: float = 24.0
    ais_confidence_min: float = 0.9
    #: a quality rule that is None is not applied; ``length_m_min`` of 0 is off as well
    presence_score_min: float | None = 0.3
    nonvessel_score_max: float | None = 0.95
    cloud_score_max: float | None = 0.5
    length_m_min: float | None = 0.0
    exclude_infrastructure: bool = True
    exclude_ice: bool = True
    #: newest points to publish; None publishes all
    points_cap: int | None = None
    hotspots_n: int = 50
    coord_decimals: int = 5
    length_step_m: int = 5
    #: 0 switches the snapping of near-shore points off
    eez_max_distance_m: float = 20_000.0
    schema_version: int = 2

    @classmethod
    def from_mapping(cls, raw: Mapping) -> Params:
        """Parameters from a plain mapping; names it leaves out keep their default, unknown names are an error."""
        known = {f.name for f in fields(cls)}
        unknown = set(raw) - known
        if unknown:
            raise KeyError(f"unknown parameters: {sorted(unknown)}")
        values = dict(raw)
        if "bbox" in values:
            values["bbox"] = tuple(values["bbox"])
        if "exclude_boxes" in values:
            values["exclude_boxes"] = tuple(tuple(b) for b in values["exclude_boxes"])
        return cls(**values)


DEFAULTS = Params()
