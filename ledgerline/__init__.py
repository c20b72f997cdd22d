"""ledgerline: a Spark-native daily equity data library.

Layers: landing text -> gate -> bronze -> silver (joined per symbol and
date) -> gold (windowed features, labels, regime) -> universe scoring and
evaluation.  Every operator is a ``DataFrame -> DataFrame`` function built
from Spark SQL expressions and windows; there is no Python UDF in the hot
path.
"""

__version__ = "0.1.0"
