"""Line KPIs for manufacturing data, computed with Spark DataFrames."""
