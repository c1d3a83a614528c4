"""Retail sales analytics as DataFrame operators on Spark."""
