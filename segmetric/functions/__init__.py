"""Column expressions shared by the operators."""

from segmetric.functions.scalar import (
    category_order, comma_list, encode_label, label_text, linspace_grid, safe_name, try_double,
)

__all__ = ["category_order", "comma_list", "encode_label", "label_text", "linspace_grid", "safe_name", "try_double"]
