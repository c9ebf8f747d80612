"""Governed-catalogue reconciliation and training-data preparation as Spark jobs."""
