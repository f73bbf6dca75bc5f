from feeloom.functions.dates import in_first_months, month_label
from feeloom.functions.keys import surrogate_key
from feeloom.functions.money import exact_mean, from_units, to_units, units_to_double

__all__ = [
    "exact_mean",
    "from_units",
    "in_first_months",
    "month_label",
    "surrogate_key",
    "to_units",
    "units_to_double",
]
