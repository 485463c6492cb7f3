"""Event-traffic and nested-document analytics on PySpark DataFrames."""
