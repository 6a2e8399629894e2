"""Column expressions shared by the operators."""

from topicpulse.functions.dates import created_date, parse_created_at
from topicpulse.functions.nested import (
    has_field,
    topic_struct,
    zero_if_null,
)

__all__ = [
    "created_date",
    "parse_created_at",
    "has_field",
    "topic_struct",
    "zero_if_null",
]
