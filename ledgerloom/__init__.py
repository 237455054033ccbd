"""Clean, conform and load record tables with Spark DataFrames."""
