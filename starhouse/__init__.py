"""Dimensional warehouse building on Spark.

Bronze feeds come in under a data contract, dimensions and the booking-grain
fact get surrogate keys, history is kept as Type 2 versions, and the result is
published as versioned parquet that marts read.
"""
