"""Composite operators: the ETL (E1-E4) and the questions over the mart (Q1-Q6)."""
