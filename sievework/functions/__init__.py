"""Scalar functions as Column builders; Arrow-batched UDFs where a scan needs state."""
