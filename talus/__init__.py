"""talus: persona analytics and corpus preparation on Spark DataFrames."""
