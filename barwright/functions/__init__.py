from barwright.functions.nulls import div, full_window, nan_to_null, nan_to_null_all, safe_divide  # noqa: F401
