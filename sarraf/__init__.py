"""sarraf: a Spark-native analytics engine for retail-banking data.

Raw records are typed and deduplicated (``plans.silver``), shaped into staging
views, dimensions, facts and business marts (``plans``), checked
(``operators.quality``) and served (``plans.serve``).  Every function maps
DataFrames to DataFrames; only ``sources`` and ``streaming`` touch storage.
"""

from sarraf.settings import RunContext
from sarraf.plans.warehouse import Warehouse

__all__ = ["RunContext", "Warehouse"]
