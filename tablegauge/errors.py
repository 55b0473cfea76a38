"""Exceptions raised by tablegauge operators."""


class TableGaugeError(Exception):
    """Base class of all errors raised by the library."""


class ValidationError(TableGaugeError):
    """A dataset, batch or argument does not satisfy a rule."""


class PreparationError(TableGaugeError):
    """Feature preparation (types, missingness, encoding) cannot proceed."""


class EvaluationError(TableGaugeError):
    """Predictions or metrics are malformed."""


class GateError(TableGaugeError):
    """A quality gate failed while being enforced."""


class TrainingError(TableGaugeError):
    """A model specification or fit is invalid."""


def refuse(kind: type[Exception], **faults) -> None:
    """Raise ``kind`` with every fault that holds: ``name=(test, text)``."""
    said = [f"{name}: {text}" for name, (test, text) in faults.items() if test]
    if said:
        raise kind("; ".join(said))
