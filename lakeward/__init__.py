"""lakeward: data-quality and analytics operators for layered tables on Spark.

``functions``  column expressions (cleaning, parsing, code expansion)
``operators``  DataFrame -> DataFrame operators (rules, keys, dedup, audit, scoring, retrieval)
``sources``    file readers with header drift and rescue, table readers, sinks
``plans``      entity specifications, star schema, KPI views, reports
``streaming``  Structured Streaming steps over the same operators
"""
