"""A PySpark-native warehouse-loading and sales-analytics engine."""
