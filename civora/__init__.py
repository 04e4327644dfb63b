"""civora: Spark-native supporter, case and content analytics.

Operators are plain functions from DataFrame to DataFrame (or to a small
fitted table). Jobs in ``civora.plans`` compose them into one lazy plan per
pipeline; nothing is collected to the driver except fitted tables whose size
is bounded by a category count or a feature count.
"""

__version__ = "0.1.0"
