"""fleetlens: Spark-native scoring of vehicle safety events.

Trip events are joined with the 4 Hz sensor series around them, cleaned,
turned into driver-behaviour features, scored and labelled. Every operator is
a ``DataFrame -> DataFrame`` function built from the DataFrame API.
"""

__version__ = "0.1.0"
