"""DataFrame operators: audit, validation, preparation, splitting,
training, evaluation, run ranking and drift."""
