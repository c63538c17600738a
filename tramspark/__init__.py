"""tramspark: transit-operations analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame(s) + parameters -> DataFrame``.
Nothing is collected to the driver except tiny scalars (high-water marks,
freshness figures).  See README.md for the module map.
"""

__version__ = "0.1.0"
