"""fareflow: trip analytics as plain Spark DataFrame, SQL and Structured
Streaming code.

Sub-packages: ``functions`` (column helpers), ``operators`` (relational,
load, quality and layout operators), ``sources`` (driver tables, readers,
writers), ``plans`` (the models, registered queries and their oracles) and
``streaming`` (Structured Streaming jobs).
"""

__version__ = "0.1.0"
