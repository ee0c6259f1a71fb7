"""tidewater: shipment visibility on Spark.

Entry points: ``plans.lake.Lake`` (every table as a lazy DataFrame over the
benchmark tables), ``plans.queries`` (registered queries), ``plans.staged``
(production batch job writing each stage's tables), ``streaming`` (Structured
Streaming jobs), ``operators`` (the DataFrame -> DataFrame building blocks).
"""

__version__ = "0.1.0"
