"""tessera: analytics operators on PySpark DataFrames.

Every public operator takes Spark DataFrames (or Columns) and returns a
DataFrame (or Column). Nothing is collected to the driver except tiny
results named in each docstring (level lists, p x p matrices, scalars).
"""

from tessera.session import get_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
