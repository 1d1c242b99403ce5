"""Analytics on tables that are stored as one snapshot per day.

Sub-packages
------------
``functions``  column expressions: calendar arithmetic, money rules, keys
``sources``    snapshot selection and text scans
``sinks``      partition writers with additive schema evolution
``operators``  DataFrame -> DataFrame operators
``plans``      complete example pipelines built from the operators
``streaming``  the incremental snapshot load as a Structured Streaming job
"""
