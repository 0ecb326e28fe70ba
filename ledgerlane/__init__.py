"""Purchasing analytics on Spark: raw purchasing tables in, marts, reports and data checks out."""
