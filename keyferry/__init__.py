"""keyferry: move operational extracts into a keyed relational target with Spark.

Layers
  functions  Column expressions: cleaning, conversion, keys, names, labels, geometry
  sources    landed extracts, string CSV files, versioned target tables
  operators  lookups, dedupe, reshape, rules, merge, validation (DataFrame in, DataFrame out)
  plans      table and source declarations, one load per business object, audit, run order
"""
