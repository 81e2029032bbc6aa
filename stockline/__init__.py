"""Demand-forecast feature engine written as PySpark DataFrame transforms."""
