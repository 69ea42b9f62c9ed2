"""posada: cleaning, modelling and profiling of vacation-rental data on Spark DataFrames."""
