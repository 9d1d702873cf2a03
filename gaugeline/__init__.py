"""Batch analytics for instrumented equipment fleets, written on the Spark DataFrame API.

``operators`` holds pure ``DataFrame -> DataFrame`` functions, ``sources`` the readers and
writers, ``plans`` the jobs that join the two, ``streaming`` the continuous form of ingestion.
"""

COMPONENTS = ("compressor", "condenser", "evaporator", "expansion_valve")
