"""windshear: flight-delay and crosswind analytics as composable Spark DataFrame operators.

Layout
------
``config``      hub parameters and the fixed reference values (bins, limits, word lists)
``schemas``     StructTypes of the raw inputs and of the mart
``functions``   Column-returning scalar operators (times, wind, labels, tolerant casts)
``operators``   DataFrame -> DataFrame steps (projections, filters, joins, aggregates, reshaping)
``sources``     readers (CSV, Parquet mart, driver-table adapters) and sinks (Parquet layout, JDBC, JSON)
``plans``       composite operators: the ETL (E1-E4) and the questions asked of the mart (Q1-Q6)
``streaming``   the same ETL over a file stream (incremental mart maintenance)
"""

from windshear.config import HubConfig

__all__ = ["HubConfig"]
