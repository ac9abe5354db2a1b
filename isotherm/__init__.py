"""Gridded daily time series on Spark: regrid, join, profile, reduce, cluster, validate.

Every operator is a plain function from DataFrame to DataFrame (usable with
``df.transform``), or a *fit* that returns a small driver-side result whose size
depends on columns, clusters or restarts and never on the number of rows.
"""
