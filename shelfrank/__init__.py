"""Book-rating analytics and recommendations as plain PySpark jobs.

Every function takes DataFrames and returns a DataFrame (or a fitted Spark ML
model); only single rows and book factors of one bounded slice reach the driver.
"""
