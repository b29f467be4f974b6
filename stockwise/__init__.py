"""Demand forecasting and stock replenishment analytics as Spark DataFrame jobs."""
