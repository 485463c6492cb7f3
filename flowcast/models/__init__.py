"""Forecast models fitted by Spark."""
