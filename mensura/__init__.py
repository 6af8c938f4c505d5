"""Spark-native analytics over periodic measurements of many entities.

The package is a set of functions from DataFrame to DataFrame.  Nothing here
holds state: tables live in Parquet folders, and a run is a chain of calls.

* ``sources``    - CSV drops, file fingerprints, declared-schema table reads
* ``functions``  - column expressions (text, dates, keys, arithmetic)
* ``operators``  - reusable relational steps (load, dedup, panel, quantile, panes)
* ``plans``      - the layers: silver, star, features, quality, publish, forecast, reads, monitoring
* ``streaming``  - the Structured Streaming forms
"""
