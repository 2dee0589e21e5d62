"""Spark-native analytics for large-scale pupil assessments.

Sub-packages
------------
``sources``    readers, layer tables and report sinks
``functions``  column expressions (text, numbers, labels, indices)
``operators``  table operators (joins, windows, aggregates, evaluation, sampling, quality, reports)
``ml``         model frames, classifiers, search, risk ranking, clustering, attribution
``plans``      the bronze / silver / gold layers and the analyses built from the operators
"""

__version__ = "0.1.0"
