"""lectern: document-corpus analytics on Spark DataFrames.

Text ingest, chunking, batch model inference, parsing and merging of
semi-structured answers, vectors, k-means, cluster profiles and a review
report, each expressed as DataFrame -> DataFrame or Column -> Column
functions so they compose with ``df.transform``.
"""

from lectern.functions.core import SENTINEL, fill_sentinel, is_present, sentinel_or

__all__ = ["SENTINEL", "fill_sentinel", "is_present", "sentinel_or"]
