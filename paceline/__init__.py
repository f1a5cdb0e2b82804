"""paceline: race-results analytics on Spark.

Layers (each a plain function returning a lazy DataFrame):

* ``paceline.sources``   raw feeds, CSV scans, layer storage
* ``paceline.functions`` Column -> Column cleaning expressions
* ``paceline.operators`` silver cleaning, star schema, marts, profiles
* ``paceline.streaming`` incremental (availableNow) bronze -> silver -> fact
* ``paceline.plans``     the query registry and its DuckDB oracles
"""

__version__ = "0.1.0"
