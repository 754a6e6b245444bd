"""Column expressions: text and sentinels, dates and weeks, code predicates, episode dating."""

from episodica.functions.codes import in_codes, starts_with_any
from episodica.functions.dates import as_midnight, days_between, lookback, whole_weeks, within
from episodica.functions.episode import Dating, age_at_first_contact
from episodica.functions.text import join_text, known, prefer_known, yes_no

__all__ = [
    "Dating",
    "age_at_first_contact",
    "as_midnight",
    "days_between",
    "in_codes",
    "join_text",
    "known",
    "lookback",
    "prefer_known",
    "starts_with_any",
    "whole_weeks",
    "within",
    "yes_no",
]
