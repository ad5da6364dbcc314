"""logsift: a Spark-native engine for web access-log analytics.

Raw log lines (batch files or streams) are parsed into a typed table with
column expressions, enriched with location by a range join, and analysed by
lazy DataFrame operators (traffic statistics and anomaly detectors).
"""

import sys

from pyspark import cloudpickle

from logsift.config import DetectorConfig
from logsift.functions.clean import clean_logs
from logsift.functions.parse import parse_lenient, parse_strict

__all__ = ["DetectorConfig", "clean_logs", "parse_lenient", "parse_strict"]

# Functions that run in Python workers are sent with the plan, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
