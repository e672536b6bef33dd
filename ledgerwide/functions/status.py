"""Traffic-light rules and sector thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwide.functions.text import col

# Canonical sector for every label seen in the data.
SECTOR_ALIASES = {
    "Acute": "Acute",
    "ACUTE": "Acute",
    "Acute Trust": "Acute",
    "Mental Health": "Mental Health",
    "MENTAL_HEALTH": "Mental Health",
    "Mental Health Trust": "Mental Health",
    "Community": "Community",
    "COMMUNITY": "Community",
    "Community Trust": "Community",
    "Ambulance": "Ambulance",
    "AMBULANCE": "Ambulance",
    "Ambulance Trust": "Ambulance",
    "Specialist": "Specialist",
    "SPECIALIST": "Specialist",
    "Specialist Trust": "Specialist",
}

# Pay as % of income above which a sector is under pressure.
PAY_AMBER = {
    "Acute": 65.0,
    "Mental Health": 70.0,
    "Community": 70.0,
    "Ambulance": 68.0,
    "Specialist": 60.0,
}
PAY_AMBER_DEFAULT = 65.0

# Fixed value: income in thousands from which a provider is large.
LARGE_INCOME_000S = 1_000_000

# Dashboard colours.
RAG_COLOURS = {"Green": "#009639", "Amber": "#FFB81C", "Red": "#DA291C"}
NO_DATA_COLOUR = "#E8EDEE"


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_sector(sector: str | Column) -> Column:
    """Known aliases map to their canonical label; anything else is kept."""
    return F.coalesce(_lookup(SECTOR_ALIASES, col(sector)), col(sector))


def pay_threshold(sector: str | Column, default: float | None = PAY_AMBER_DEFAULT) -> Column:
    found = _lookup(PAY_AMBER, col(sector))
    return found if default is None else F.coalesce(found, F.lit(default))


def pay_pressure_flag(pay_pct: str | Column, sector: str | Column, default: float | None = None) -> Column:
    """1 when pay % is above the sector threshold. With no default an unknown sector gives 0."""
    return F.coalesce((col(pay_pct) > pay_threshold(sector, default)).cast("int"), F.lit(0))


def is_large(income_000s: str | Column) -> Column:
    return F.coalesce((col(income_000s) >= LARGE_INCOME_000S).cast("int"), F.lit(0))


@dataclass(frozen=True)
class Bands:
    """Green from ``green`` up, Amber from ``amber`` up, else Red (or mirrored)."""

    green: float
    amber: float
    higher_is_better: bool = True

    def status(self, value: str | Column, when_null: str | None = "Grey") -> Column:
        value = col(value)
        if self.higher_is_better:
            good, fair = value >= self.green, value >= self.amber
        else:
            good, fair = value < self.green, value < self.amber
        graded = F.when(good, "Green").when(fair, "Amber").otherwise("Red")
        blank = F.lit(when_null).cast("string")
        return F.when(value.isNull(), blank).otherwise(graded)


# Thresholds in percent.
EBITDA_BANDS = Bands(5.0, 2.0)
SURPLUS_BANDS = Bands(0.0, -2.0)
PAY_BANDS = Bands(65.0, 70.0, higher_is_better=False)
CIP_BANDS = Bands(100.0, 80.0)


def sign_status(amount: str | Column, when_null: str = "Green") -> Column:
    """Red below zero, Amber at zero, Green above."""
    amount = col(amount)
    return (
        F.when(amount.isNull(), when_null)
        .when(amount < 0, "Red")
        .when(amount == 0, "Amber")
        .otherwise("Green")
    )


def rag_colour(status: str | Column) -> Column:
    return F.coalesce(_lookup(RAG_COLOURS, col(status)), F.lit(NO_DATA_COLOUR))
