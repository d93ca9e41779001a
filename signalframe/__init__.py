"""signalframe: news and load signals as Spark DataFrames."""
