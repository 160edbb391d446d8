"""sluice: a PySpark-native engine for landing, validating and curating tables.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame), ``sources`` (readers and intake), ``streaming`` (micro-batch facade)
and ``plans`` (the query catalogue with its SQL twins).
"""

__version__ = "0.1.0"
