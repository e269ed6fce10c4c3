"""cairnflow: analytics and data-preparation operators expressed on Spark DataFrames."""

__version__ = "0.1.0"
