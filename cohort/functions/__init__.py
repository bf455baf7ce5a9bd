from cohort.functions.expressions import (  # noqa: F401
    binary_entropy,
    bucket,
    choose2,
    is_allowed,
    pseudonymize,
)
