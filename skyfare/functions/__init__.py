"""Column-expression helpers. Every helper returns a built-in Spark Column;
none of them is a Python UDF."""

from skyfare.functions.scalar import (airline_name, as_date, aud_label, day_start,
                                       dollar_label, empty_frame, literal_rows, local_date,
                                       present, route_code, split_first, strip_ws,
                                       tolerant_double)

__all__ = ["airline_name", "as_date", "aud_label", "day_start", "dollar_label",
           "local_date", "present", "route_code", "split_first", "strip_ws",
           "tolerant_double"]
