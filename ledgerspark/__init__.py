"""Receivables, payment reconciliation and bureau-file work as Spark DataFrame jobs."""
