"""stakeflow: a Spark-native engine for player/game interaction analytics.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built on
Spark SQL.  Sub-packages:

* ``sources``   – table readers, fixture views, collection loaders, sinks
* ``functions`` – pure Column expressions (mappers, parsers, buckets)
* ``operators`` – joins (as-of), events, features, dataset split, scoring,
                  metrics, analytics, explanations, training
* ``plans``     – named end-to-end queries used by the driver and the bench
* ``streaming`` – (no streaming operators: the source system is batch only)
"""

__version__ = "0.1.0"
