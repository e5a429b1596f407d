"""loadwitness: did a load arrive intact, and what does its run report say?

Every function takes DataFrames (or Columns) and returns DataFrames (or Columns); nothing here
loops over pipelines on the driver.
"""
