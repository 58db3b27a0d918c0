"""Layered (bronze / silver / gold) order analytics as Spark DataFrame transformations."""
