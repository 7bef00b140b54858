"""Where the raw files of each city are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RawLayout:
    """``{root}/listing/{City}Listings.csv`` and the like, one file or folder per city.

    The three sub-folders and the file name patterns can be changed for other layouts.
    """

    root: str
    cities: tuple[str, ...] = ("BERLIN", "PARIS", "MADRID")
    listing_pattern: str = "listing/{City}Listings.csv"
    calendar_pattern: str = "calendar/{City}Calendar.csv"
    review_pattern: str = "review/{City}Reviews.txt"

    def _paths(self, pattern: str) -> dict[str, str]:
        root = self.root.rstrip("/")
        return {
            city: f"{root}/{pattern.format(City=city.title(), CITY=city)}"
            for city in self.cities
        }

    def listings(self) -> dict[str, str]:
        return self._paths(self.listing_pattern)

    def calendars(self) -> list[str]:
        return list(self._paths(self.calendar_pattern).values())

    def reviews(self) -> list[str]:
        return list(self._paths(self.review_pattern).values())
