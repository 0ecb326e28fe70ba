"""Whole flows made of the operators: ingest, marts, reports, checks."""
