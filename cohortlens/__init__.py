"""Spark-native customer analytics: mart, cleaning, RFM segmentation, reporting and synthetic expansion."""
