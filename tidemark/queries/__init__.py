"""All registered queries and their SQL answers."""

from tidemark.queries import (  # noqa: F401
    events,
    graphs,
    models,
    quality,
    reports,
    sequences,
    storage,
    streams,
    tables,
    texts,
)
from tidemark.queries.registry import ORACLES, QUERIES  # noqa: F401
