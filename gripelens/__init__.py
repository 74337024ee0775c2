"""gripelens: review-signal analytics as PySpark DataFrame jobs.

Packages
--------
functions   column expressions (text shape, labels, dates, display names)
operators   DataFrame -> DataFrame jobs (sampling, sentiment, language, quantiles, ML)
plans       per-platform presets and the end-user reports composed from operators
sources     readers and writers
streaming   monitoring of incoming reviews
checks      queries over the driver tables and their SQL counterparts
"""
