"""Drug-safety signal analytics as Spark DataFrame jobs.

Reports arrive as nested JSON, are staged once into a typed nested table and
are then aggregated into drug x reaction statistics.  Every function takes and
returns DataFrames or Columns; see README.md for the map of the package.
"""
