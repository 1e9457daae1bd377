"""Comparison helpers shared by the oracle script and the tests."""

import math


def norm_value(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}".rstrip("0").rstrip(".").replace("-0", "0") if abs(v) < 1e15 else f"{v:.6e}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm_value(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm_value(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def sorted_rows(cols, rows):
    """Rows with columns in name order, values normalised, rows sorted (order-insensitive compare)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm_value(r[i]) for i in order) for r in rows)
