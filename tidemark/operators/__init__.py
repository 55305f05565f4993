"""DataFrame transforms: functions from DataFrames to DataFrames."""
