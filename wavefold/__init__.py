"""wavefold: survey microdata on Spark.

Fixed-width scans, dictionary layouts, catalog matching, incremental plans and
longitudinal person panels, all as DataFrame transformations.
"""

__version__ = "0.1.0"
