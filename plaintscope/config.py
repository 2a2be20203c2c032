"""Thresholds and fixed values shared by every job.

All thresholds are arguments with these defaults; nothing below is read from
the environment.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # volume signals
    company_baseline_weeks: int = 4      # rows in the rolling company frame
    min_baseline_weeks: int = 3          # alert gate
    min_alert_count: int = 20            # alert gate
    settle_days: int = 21                # alert gate: week must end this far before the last date
    publication_lag_days: int = 14       # data_status = 'Complete' cut-off
    product_baseline_days: int = 28      # rows in the rolling product frame
    product_growth_lag: int = 7          # rows back for product week-over-week growth
    min_baseline_days: int = 14          # product report gate
    critical_z: float = 3.0
    warning_z: float = 2.0
    watch_growth: float = 40.0
    # themes
    recent_days: int = 7
    baseline_days: int = 28
    min_recent_mentions: int = 3
    min_doc_freq: int = 3
    max_theme_terms: int = 15000
    themes_kept: int = 30
    themes_per_product: int = 3
    narratives_per_theme: int = 5
    theme_text_chars: int = 1500
    single_text_chars: int = 6000
    min_supporting_records: int = 3
    # classifier
    min_class_size: int = 50
    test_fraction: float = 0.20
    split_seed: int = 42
    max_vocab: int = 20000
    max_iter: int = 1000


DEFAULTS = Thresholds()

# Alert levels in severity order (most severe first).
ALERT_LEVELS = ("Critical", "Warning", "Watch")
NORMAL_LEVEL = "Normal"
COMPLETE = "Complete"
INCOMPLETE = "Incomplete"

# Urgency domain of a structured theme answer.
URGENCY_LEVELS = ("Low", "Medium", "High", "Critical")

# Field texts a raw extract reader treats as missing (the pandas CSV defaults).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Allowed timely-response answers after trim + lower-case.
TIMELY_DOMAIN = ("yes", "no")
