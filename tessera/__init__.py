"""tessera: metadata-driven lake loading, quality, modelling and event rollups as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Run time and run id are arguments, so
results repeat; only the sinks, the streaming runners and the end-to-end jobs start Spark actions.
"""
