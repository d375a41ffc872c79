"""panelwright: entity x period panel analytics on Spark DataFrames.

Every public operator is a function from DataFrames and column names to a
DataFrame (or a small driver-side result such as a list of column names that
comes out of one bounded aggregation).  Catalyst plans the work; nothing
data-sized is collected to the driver.
"""

from panelwright.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
