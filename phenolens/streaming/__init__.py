"""Mini-batch k-means for static batches and Structured Streaming."""

from .kmeans import (
    StreamingKMeans,
    assign,
    batch_statistics,
    centres_frame,
    centres_long,
    nearest_centre,
    random_centres,
    run_stream,
    update,
    update_centres,
)

__all__ = [
    "StreamingKMeans",
    "assign",
    "batch_statistics",
    "centres_frame",
    "centres_long",
    "nearest_centre",
    "random_centres",
    "run_stream",
    "update",
    "update_centres",
]
