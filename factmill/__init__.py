"""factmill: event-evidence analytics expressed as Spark DataFrames."""
