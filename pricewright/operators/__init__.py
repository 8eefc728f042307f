"""DataFrame operators: functions from DataFrames to DataFrames, and fit / transform pairs."""
