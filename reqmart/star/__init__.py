"""The reports on a star-schema data set: inputs in the reports' shape, queries, and checking SQL."""
