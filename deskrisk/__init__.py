"""deskrisk: market-risk analytics written as Spark DataFrame jobs.

Every public function takes DataFrames and returns a DataFrame (or writes one
table); nothing in the data path is collected on the driver.
"""

__version__ = "0.1.0"
