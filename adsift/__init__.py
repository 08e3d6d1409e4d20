"""adsift: ad-delivery log analytics as DataFrame operators on PySpark.

Every public function takes DataFrames (plus plain parameters) and returns a
DataFrame built from Spark's own expressions, so Catalyst plans, prunes and
pushes down the whole job. Nothing unbounded is collected to the driver.
"""

__version__ = "0.1.0"
