"""Sliding-window log analytics and anomaly scoring as Spark DataFrame jobs."""
