"""bandwise: prediction intervals, calibration and anomaly audits as Spark jobs.

Every operator takes a DataFrame and column names and returns a DataFrame.
Fitted parameters (a handful of numbers per model or per segment) are the
only values that reach the driver; rows never do.
"""

__version__ = "0.1.0"
