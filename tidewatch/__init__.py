"""Account-retention analytics expressed as Spark DataFrame transformations.

Every public function takes DataFrames plus a :class:`~tidewatch.settings.Settings`
and returns a lazy DataFrame.  Only the sinks, the fit steps (which read a
small dictionary of category values) and model training run Spark jobs.
"""

from tidewatch.settings import Settings

__all__ = ["Settings"]
