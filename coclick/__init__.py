"""coclick: item retrieval from behaviour logs, as Spark DataFrame operators.

Every public function takes DataFrames and returns a DataFrame; nothing
collects data to the driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
