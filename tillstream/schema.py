"""Column names and schemas shared by the batch and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# The positional layout of a raw invoice line.
LINE_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

LINE_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

# The feature order every model, saved or literal, is trained on.
FEATURE_COLUMNS = ["AvgUnitPrice", "MinUnitPrice", "MaxUnitPrice", "Time", "NumberItems"]

# The same five features as a windowed invoice names them.
WINDOW_FEATURE_COLUMNS = [
    "avgUnitPrice",
    "minUnitPrice",
    "maxUnitPrice",
    "time",
    "numberItems",
]

# Output feed names that consumers subscribe to.
CANCELLATIONS_TOPIC = "cancelaciones"
MALFORMED_TOPIC = "facturas_erroneas"
KMEANS_ANOMALIES_TOPIC = "anomalias_kmeans"
BISECTING_ANOMALIES_TOPIC = "anomalias_bisect_kmeans"

# Lines that came after their windows were closed; this feed is an addition.
LATE_TOPIC = "late_lines"
