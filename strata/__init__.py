"""strata: a Spark-native medallion ETL and analytics library.

Tables move through bronze (raw copy), silver (cleaned) and gold (curated)
layers under a batch window, and three analytics marts are answered on the
result.  Every step is a DataFrame expression or a DataFrame -> DataFrame
function, so Catalyst plans the whole load at once.
"""

__version__ = "0.1.0"
