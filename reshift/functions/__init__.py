"""Scalar column expressions: labels, predicates, CPU weights."""

from reshift.functions.columns import (  # noqa: F401
    div,
    family,
    in_window,
    is_ec2,
    lasts_at_most_an_hour,
    os_label_from_description,
    size_of,
    type_label,
)
from reshift.functions.cpu import rule_rows, rule_table, with_cpu_weight  # noqa: F401
