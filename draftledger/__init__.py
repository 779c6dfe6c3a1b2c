"""draftledger: draft-league scoring as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function. League tables carry a
``draft_id`` column so one job scores any number of leagues at once; windows
partition by it and joins use it as an equi-key.
"""

from draftledger.params import Season

__all__ = ["Season"]
