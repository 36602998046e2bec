"""lumisort: binary image-feature classification on Spark, one DataFrame operator at a time.

Subpackages: ``functions`` (column rules), ``sources`` / ``sinks`` (readers and
writers), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (end-to-end
jobs), ``streaming`` (Structured Streaming scoring), ``catalog`` (registered
queries with SQL twins).
"""

__version__ = "0.1.0"
