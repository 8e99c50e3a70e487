"""tallyframe: tidy analytics, statistics-package null rules and modelling on Spark DataFrames."""
