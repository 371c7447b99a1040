"""Service-point analytics as PySpark DataFrame operators.

Raw all-string snapshots are typed into a star schema, every service point's
rush hours and rush-hour waits are found, ratings are weighted by votes, and the
points are ranked by a weighted sum of normalised criteria.
"""

from servicerank.session import get_session

__all__ = ["get_session"]
