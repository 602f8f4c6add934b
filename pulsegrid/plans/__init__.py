"""Every query, grouped by subject; importing this package fills the registry."""

from pulsegrid.plans import (  # noqa: F401
    checked_models,
    graphs,
    jobs,
    linear,
    messages,
    models,
    power,
    relational,
    sources,
    state,
    streams,
)
from pulsegrid.plans.registry import ORACLES, QUERIES  # noqa: F401
