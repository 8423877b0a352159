"""All registered queries and their SQL; importing the modules of plans registers them."""

from __future__ import annotations

from envflow.plans import geo_queries, raster_queries, scalar_queries, stream_queries, table_queries  # noqa: F401
from envflow.registry import ORACLES, QUERIES  # noqa: F401
