"""Scalar column expressions (all built-in Spark functions, no Python UDFs)."""

from civora.functions.columns import *  # noqa: F401,F403
