"""Operators: cleaning, time ranges, dimensions, fact and metrics."""

from triploom.operators.clean import clean_trips, split_rejects  # noqa: F401
from triploom.operators.dense_ids import Numbered, assign_dense_ids  # noqa: F401
from triploom.operators.dims import (  # noqa: F401
    Conformed, StarDims, Upsert, build_dim, conform_dims, dim_upsert,
    name_members, point_members, trip_tuples,
)
from triploom.operators.fact import trip_fact  # noqa: F401
from triploom.operators.metrics import (  # noqa: F401
    endpoint_points, weekly_avg_bbox, weekly_avg_bbox_star, weekly_avg_by_region,
    weekly_avg_by_region_star, weekly_trip_counts,
)
from triploom.operators.time_range import (  # noqa: F401
    assign_by_range_join, range_bucket_join, time_range_assign, time_range_dim,
)
