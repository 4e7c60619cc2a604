"""clipforge: press-clipping processing expressed as Spark DataFrame jobs.

Every public function takes DataFrames (plus keyword options) and returns a
DataFrame; nothing is collected to the driver.
"""

__all__ = ["session"]
