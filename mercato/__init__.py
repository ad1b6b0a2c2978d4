"""mercato — marketplace order analytics as Spark DataFrame jobs.

Layers (each a function from DataFrames to a lazy DataFrame):

* ``sources``   raw CSV ingest, validation, profiling, sinks, test-data adapter
* ``functions`` column helpers (rounding, rates, weighted means, text normalisation)
* ``operators`` reusable relational building blocks (latest row per key,
  scalable global rank / ntile / running share, guarded broadcast, data checks)
* ``plans``     staging -> intermediate -> marts -> analyses (+ extensions)
* ``streaming`` intentionally empty: the modelled pipeline is batch only
"""

__version__ = "0.1.0"
