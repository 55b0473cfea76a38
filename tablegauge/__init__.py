"""tablegauge: table quality, preparation, training, evaluation and drift
operators expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns DataFrames; only bounded
summaries (one row per rule, per class, per column or per feature) are
ever brought to the driver.
"""

from tablegauge.errors import (  # noqa: F401
    EvaluationError,
    GateError,
    PreparationError,
    TrainingError,
    ValidationError,
)

__version__ = "0.1.0"
