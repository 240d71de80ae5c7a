"""faultline: exception-log analytics on Spark DataFrames."""

from faultline.config import LogSchema, Params, tpch_params, tpch_schema  # noqa: F401

__version__ = "0.1.0"
