"""Every operator as a query over the test tables."""

from cellweft.queries import (aggregates, clusters, joins, labels, models, projections, reports, samples, sources,
                              streams, transforms)
from cellweft.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "clusters", "joins", "labels", "models", "projections", "reports",
           "samples", "sources", "streams", "transforms"]
