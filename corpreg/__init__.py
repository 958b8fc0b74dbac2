"""corpreg: a Spark-native company registry built from sources that share no key.

Operators are DataFrame -> DataFrame functions over Spark SQL built-ins and
Spark ML; the caller owns the SparkSession.
"""

from corpreg.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
