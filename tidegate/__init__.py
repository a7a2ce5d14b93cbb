"""Spark-native table loading and reconciliation.

Operators take DataFrames and explicit arguments (keys, watermarks, id lists, as-of time) and
return DataFrames. Sources and sinks are thin wrappers over Spark's readers and writers; `plans`
composes them into the loads.
"""
