"""Incremental report marts over request-keyed facts, on Spark DataFrames.

Layers, each built on the one before:

``functions``  column expressions (times, labels, calendar, fixed values)
``operators``  generic DataFrame operators (keys, lookups, reshaping, aggregates)
``sources``    table and path readers, and the report store that writes tables
``plans``      the reports and the steps of a refresh run
``star``       the same reports shown on a star-schema data set
"""
