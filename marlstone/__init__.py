"""Layered (bronze, silver, gold) analytics as PySpark DataFrame operators and jobs."""
