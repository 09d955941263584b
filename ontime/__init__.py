"""On-time-performance analytics for airline flights, written for Spark.

Raw flight, airport and delay-cause files become a star schema, the star
becomes delay reports, and the enriched facts become training frames for
delay classifiers. Every operator takes and returns Spark DataFrames.
"""
