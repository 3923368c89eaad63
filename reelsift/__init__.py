"""reelsift: media-catalogue and audience analytics on Spark DataFrames."""
