"""pricenet — price-similarity networks on Spark.

A library of DataFrame -> DataFrame functions.  Every table carries the
grouping key ``(year, category)`` so all networks of a run are computed in
one distributed plan instead of one driver loop per slice.
"""

from pricenet.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
