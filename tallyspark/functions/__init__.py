from tallyspark.functions.hashing import hash52, uniform  # noqa: F401
from tallyspark.functions.scalar import (  # noqa: F401
    half_even_int, log_uniform, outcome_message, quniform, sigmoid, truncate_int,
)
