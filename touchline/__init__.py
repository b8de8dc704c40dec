"""touchline: league analytics as Spark DataFrame jobs.

Sub-packages:

* ``functions`` - Column -> Column expressions (text normalisers, parsers,
  ordering helpers). Everything compiles to built-in Catalyst expressions.
* ``sources``   - readers/writers for the raw CSV layout, the season
  dimension generator and the star-schema shim used for oracle checks.
* ``operators`` - reusable relational steps (team unpivot, running totals,
  streaks, standings, per-season aggregates, ingest, HTML extraction).
* ``plans``     - the four marts and the full/incremental pipelines.
* ``streaming`` - a file-source front end for captured pages.
"""

__version__ = "0.1.0"
