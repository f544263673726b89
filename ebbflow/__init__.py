"""ebbflow: a Spark-native event lake and file-governance engine.

Subpackages: ``functions`` (Column helpers), ``operators`` (DataFrame ->
DataFrame steps), ``sources`` / ``sinks`` (files in, Parquet out),
``plans`` (end-to-end runs and the registered queries), ``streaming``
(incremental ingestion).
"""

__version__ = "0.1.0"
