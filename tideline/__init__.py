"""tideline: event-stream and table operators expressed as PySpark DataFrames."""
