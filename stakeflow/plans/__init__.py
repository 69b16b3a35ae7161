"""Named end-to-end queries.

* ``stages``    - the fixture stages (bets -> enriched -> events -> features -> dataset),
  memoised per scale directory, with checkpoints at the shared stages;
* ``catalog``   - the registry (name -> Spark builder, DuckDB oracle SQL, covered SURVEY IDs);
* ``oracle``    - SQL builders for the oracle twins;
* ``queries_*`` - the registered queries, grouped by area.
"""
