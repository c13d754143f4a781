"""Immune-receptor sequencing analytics as composable PySpark jobs."""
