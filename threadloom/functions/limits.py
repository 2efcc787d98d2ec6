"""Bounds of what callers may ask for; anything beyond is brought to the nearest bound."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest and highest value of each knob, by stage.
LIMITS = {
    "enrich": {"limit": (1, 1_000_000)},
    "catalog": {"limit": (1, 100_000), "batch_size": (1, 25), "slice_limit": (200, 2500), "max_slices": (1, 16), "max_batches": (1, 200)},
    "emergent_catalog": {"limit": (1, 500), "batch_size": (1, 25), "slice_limit": (50, 2500), "max_slices": (1, 8)},
    "assign": {"batch_size": (1, 25), "max_batches": (1, 200), "max_workers": (1, 12), "reset_rows": (1, 200_000)},
    "detect": {"batch_size": (1, 25), "max_batches": (1, 200), "max_workers": (1, 12), "reset_rows": (1, 20_000)},
    "emergent_assign": {"batch_size": (1, 25), "max_batches": (1, 500), "max_workers": (1, 12), "stale_minutes": (10, 1440)},
    "nuggets": {"limit": (1, 2000), "max_workers": (1, 40)},
    "variants": {"limit": (1, 500), "max_workers": (1, 12), "min_usefulness": (0.0, 1.0)},
    "scenarios": {"limit": (1, 500), "max_workers": (1, 24), "ramp_step": (1, 8), "ramp_interval": (10, 300), "min_usefulness": (0.0, 1.0)},
    "topics": {"limit": (1, 200)},
    "search": {"top": (1, 10)},
}


def bounded(stage: str, **knobs):
    """The knobs of a stage within their limits; a knob without limits is an error."""
    out = {}
    for name, value in knobs.items():
        low, high = LIMITS[stage][name]
        out[name] = max(low, min(high, value))
    return out


def bounded_column(stage: str, name: str, value: Column) -> Column:
    """The same for a column of requests."""
    low, high = LIMITS[stage][name]
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def batches_for(limit: int, batch_size: int, max_batches: int = 0) -> int:
    """How many batches a catalog run makes: as many as the limit asks for where none are named, within their limits."""
    return bounded("catalog", max_batches=max_batches if max_batches > 0 else -(-limit // batch_size))["max_batches"]
