"""tessera: retail, metric, layout, learning and text jobs expressed as Spark DataFrame plans.

Every operator is a plain function ``f(DataFrame..., **params) -> DataFrame``; nothing is
collected to the driver.  ``tessera.plans.registry`` binds the operators to the test tables
(``key(spark, sf_dir) -> DataFrame``) and holds the DuckDB oracle SQL for each key.
"""

__all__ = ["session"]
