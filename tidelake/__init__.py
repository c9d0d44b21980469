"""Layered, monthly data lakes on PySpark: CSV landing, partition overwrite, keyed
upsert, commit-based incremental reads, and wide trip marts.

Layers are ``stg`` (raw CSV), ``ods`` (typed, partitioned), ``dwh`` (conformed) and
``dmt`` (marts). Everything is DataFrame or Spark SQL code.
"""
