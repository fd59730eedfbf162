"""faultlens: incident-signal analytics as plain Spark DataFrame operators.

Alerts, metric samples, logs and change records go in; canonical anomaly
signals and ranked incident causes come out.  Every operator takes and returns
DataFrames (or Columns), so batch and Structured Streaming share the code.
"""

__version__ = "0.1.0"
