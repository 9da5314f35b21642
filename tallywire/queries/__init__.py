"""All queries and their SQL twins."""

from tallywire.queries import (  # noqa: F401  (importing registers)
    model_jobs,
    projections,
    scalars,
    sources,
    statistics,
    streams,
    windows,
)
from tallywire.queries.common import ORACLES, QUERIES  # noqa: F401
