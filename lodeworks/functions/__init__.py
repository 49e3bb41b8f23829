from lodeworks.functions.columns import bucket_of, multi_hot_columns, scaled, thermometer_columns
from lodeworks.functions.text import collapse_ws, split_literal, strip_ws

__all__ = [
    "bucket_of", "collapse_ws", "multi_hot_columns", "scaled", "split_literal", "strip_ws",
    "thermometer_columns",
]
