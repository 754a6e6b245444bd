"""Episode dating: start, due date and age from a reported start or a reported age."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from episodica.functions.dates import as_midnight, whole_weeks


@dataclass(frozen=True)
class Dating:
    """The rule that dates an episode.

    A reported start counts unless its year is ``unknown_year``; otherwise the event date minus the reported age in
    units (weeks); otherwise the episode has no dates. Due date and age both follow from the start.
    """

    episode_days: int = 294
    unit_days: int = 7
    unknown_year: int = 3000

    @property
    def unknown_date(self) -> datetime.date:
        return datetime.date(self.unknown_year, 12, 31)

    def start(self, reported: Column, reported_year: Column, event_date: Column, units: Column) -> Column:
        estimated = F.date_sub(event_date, (units * F.lit(self.unit_days)).cast("int"))
        return F.when(reported_year != self.unknown_year, reported).when(units.isNotNull(), estimated)

    def due(self, start: Column) -> Column:
        return as_midnight(F.date_add(start, self.episode_days))

    def age(self, start: Column, on: Column) -> Column:
        return whole_weeks(on, start, self.unit_days)

    def is_known(self, start: Column) -> Column:
        """True for a start that is neither NULL nor the sentinel date."""
        return start != F.lit(self.unknown_date)


def age_at_first_contact(
    start: Column, first_contact: Column, first_reported_age: Column, dating: Dating = Dating()
) -> Column:
    """Age on the first dated contact; the first reported age where the start is not usable."""
    return F.when(F.year(start) != dating.unknown_year, dating.age(start, first_contact)).when(
        first_reported_age.isNotNull(), first_reported_age
    )
