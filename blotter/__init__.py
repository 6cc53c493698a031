"""blotter: incident analytics on Spark.

Feeds in several layouts are mapped to one canonical incident table,
sub-types are classified through a lookup, coordinates are added or
converted, and the table is summarised, turned into model features and
scored. Every step is a Spark DataFrame / SQL / MLlib plan; nothing is
collected to the driver.
"""

__version__ = "0.1.0"
