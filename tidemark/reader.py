"""What a user asks of the store, by series, concept and day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import vintage as V


@dataclass(frozen=True)
class Store:
    """Events of all vintages, the accepted vintages with the day they became available, and the series of each concept.

    Every answer is a DataFrame, and names given to it reach the events before anything is ranked. Unknown names give no rows.
    """

    events: DataFrame
    accepted: DataFrame
    concepts: DataFrame | None = None

    def _of(self, *series_ids: str) -> DataFrame:
        return self.events.filter(F.col("series_id").isin(*series_ids)) if series_ids else self.events

    def latest(self, *series_ids: str) -> DataFrame:
        """Realised values as last published."""
        return V.realised(V.latest(self._of(*series_ids), self.accepted))

    def publisher_statement(self, *series_ids: str) -> DataFrame:
        """The publisher's last statement, projections included."""
        return V.latest(self._of(*series_ids), self.accepted)

    def as_of(self, day, *series_ids: str) -> DataFrame:
        """Realised values as known on a day."""
        return V.as_of(self._of(*series_ids), self.accepted, day)

    def statement_as_of(self, day, *series_ids: str) -> DataFrame:
        """The publisher's statement as known on a day."""
        return V.as_of(self._of(*series_ids), self.accepted, day, statement=True)

    def revision_history(self, *series_ids: str) -> DataFrame:
        """Every statement of an accepted vintage, removals included."""
        return self._of(*series_ids).join(self.accepted.select("vintage_id"), "vintage_id", "left_semi")

    def by_concept(self, *concept_ids: str) -> DataFrame:
        """Realised values of the series of concepts."""
        if self.concepts is None:
            raise ValueError("this store has no concepts")
        chosen = self.concepts.filter(F.col("concept_id").isin(*concept_ids)) if concept_ids else self.concepts
        members = chosen.select("series_id", "concept_id")
        return V.realised(V.latest(self.events.join(members, "series_id", "left_semi"), self.accepted)).join(members, "series_id")

    def catalogue(self) -> DataFrame:
        """Coverage of each series by its publisher's statement."""
        return V.catalogue(self.publisher_statement())
