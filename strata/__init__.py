"""Layered warehouse (bronze, silver, gold) on Spark."""
