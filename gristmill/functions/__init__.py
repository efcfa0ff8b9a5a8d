"""Column expressions shared by the operators; nothing here starts a Spark job."""

from gristmill.functions.distance import nearest, squared_distance, squared_norm
from gristmill.functions.hashing import key_rank
from gristmill.functions.names import quoted
from gristmill.functions.numbers import parse_number

__all__ = [
    "key_rank",
    "nearest",
    "parse_number",
    "quoted",
    "squared_distance",
    "squared_norm",
]
