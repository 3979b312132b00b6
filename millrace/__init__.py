"""millrace: delivery and notification analytics as composable Spark operators.

Every operator takes DataFrames plus plain parameters and returns a DataFrame;
nothing is collected in the core, and calendars, rules, dates and quotas are
arguments rather than constants.
"""

__version__ = "0.1.0"
