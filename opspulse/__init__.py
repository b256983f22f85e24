"""opspulse: hourly operational time-series analytics on Spark DataFrames."""
