"""Company matching and ownership networks as Spark jobs.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing here keeps global settings or collects data to the driver.
"""

__version__ = "0.1.0"
