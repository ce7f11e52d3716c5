from niaga.functions.arithmetic import div_exact, fold_rows, mean, ratio_round
from niaga.functions.calendar import date_key, date_key_of, date_month, elapsed_days, whole_seconds
from niaga.functions.labels import number_label, percent_label, rupiah_label, title_case

__all__ = [
    "date_key",
    "date_key_of",
    "date_month",
    "div_exact",
    "elapsed_days",
    "fold_rows",
    "mean",
    "number_label",
    "percent_label",
    "ratio_round",
    "rupiah_label",
    "title_case",
    "whole_seconds",
]
