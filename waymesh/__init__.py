"""Line-network conflation analytics on Spark DataFrames."""
