"""The reports and the steps of a refresh run; every report is a function of DataFrames."""
