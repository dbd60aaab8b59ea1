"""Role-driven table analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# The small functions that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .operators.models import available_models  # noqa: E402
from .plans.analyze import Analysis, analyze  # noqa: E402
from .sources.reader import load_table  # noqa: E402

__all__ = ["Analysis", "analyze", "available_models", "load_table"]
