"""Sequencing-data analytics as Spark DataFrame operators."""
