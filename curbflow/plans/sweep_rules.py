"""Which sensor readings count as water on, brush on, in motion."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Reading:
    """Inputs that must be on for a vehicle type; no companies means any company."""

    vehicle_type: int
    companies: tuple[int, ...]
    inputs: tuple[str, ...]
    every_input: bool = False

    def holds(self) -> Column:
        on = [F.col(name) > 0 for name in self.inputs]
        test = (F.col("vehicle_type") == self.vehicle_type) & reduce(and_ if self.every_input else or_, on)
        return test & F.col("company_type").isin(*self.companies) if self.companies else test


@dataclass(frozen=True)
class SweepRules:
    water: tuple[Reading, ...]
    brush: tuple[Reading, ...]
    sides: tuple[Reading, ...]
    slowest: float
    fastest: float
    needs_ignition: bool
    # True: vehicles with sides count on a side alone. False: a side, or water with brush.
    sides_only: bool

    def flags(self) -> dict[str, Column]:
        """Flag columns over vehicle_type, company_type, input1-4, speed, ignition; never null."""
        moving = F.col("speed").between(self.slowest, self.fastest)
        if self.needs_ignition:
            moving = moving & F.col("ignition")
        water, brush, side = (self._any(rules) for rules in (self.water, self.brush, self.sides))
        both = water & brush
        if self.sides_only:
            sided = reduce(
                or_,
                (
                    (F.col("vehicle_type") == rule.vehicle_type) & F.col("company_type").isin(*rule.companies)
                    for rule in self.sides
                ),
            )
            works = F.when(sided, side).otherwise(both)
        else:
            works = both | side
        gps = F.coalesce(moving, F.lit(False))
        return {"gps_on": gps, "water_on": water, "brush_on": brush, "side_on": side, "valid": gps & works}

    @staticmethod
    def _any(rules: tuple[Reading, ...]) -> Column:
        return F.coalesce(reduce(or_, (F.coalesce(rule.holds(), F.lit(False)) for rule in rules)), F.lit(False))


# Fixed values of both rule sets: vehicle type, company types, inputs, speeds.
RIGHT_SIDE = Reading(16, (3,), ("input1", "input2"), every_input=True)
LEFT_SIDE = Reading(16, (3,), ("input3", "input4"), every_input=True)

CURRENT = SweepRules(
    water=(
        Reading(4, (1, 2), ("input3",)),
        Reading(16, (1,), ("input3",)),
        Reading(16, (3,), ("input2", "input3")),
        Reading(24, (1, 2, 3), ("input1",)),
    ),
    brush=(
        Reading(4, (1, 2), ("input2",)),
        Reading(16, (1,), ("input2",)),
        Reading(16, (3,), ("input1", "input4")),
        Reading(24, (1, 2, 3), ("input2", "input4"), every_input=True),
    ),
    sides=(RIGHT_SIDE, LEFT_SIDE),
    slowest=0.5,
    fastest=30,
    needs_ignition=False,
    sides_only=True,
)

LEGACY = SweepRules(
    water=(
        Reading(1, (1,), ("input3",)),
        Reading(1, (2,), ("input2",)),
        Reading(2, (), ("input1",)),
        Reading(3, (2,), ("input1",)),
        Reading(16, (1,), ("input3",)),
        Reading(16, (3,), ("input2", "input3")),
    ),
    brush=(
        Reading(1, (1, 3), ("input2",)),
        Reading(2, (), ("input2",)),
        Reading(3, (2,), ("input2",)),
        Reading(16, (1, 2), ("input2",)),
        Reading(16, (3,), ("input1", "input4")),
    ),
    sides=(RIGHT_SIDE, LEFT_SIDE),
    slowest=1,
    fastest=29,
    needs_ignition=True,
    sides_only=False,
)
