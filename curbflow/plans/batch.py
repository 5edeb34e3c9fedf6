"""One ping batch: every frame it produces, from the pings to the contracts.

Frames that several steps read are settled with a checkpoint, so the pings are
read twice (tag reads, position reads) whatever is asked for, and plans stay
short. Settled frames are small beside the pings: one row per tag, per planned
stop with such a tag, per driven street, per trip or per plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from curbflow.functions.numeric import at_most_hundred
from curbflow.functions.text import tag_key
from curbflow.plans import lifting, matching, rollup, service_log, sweeping
from curbflow.plans.history import History
from curbflow.plans.sweep_rules import CURRENT, SweepRules
from curbflow.session import cut_lineage
from curbflow.sources.pings import lift_reads, new_tag_references, sweep_reads


@dataclass(frozen=True)
class Choices:
    """Where the procedure followed has a quirk: the default keeps it, the other value mends it."""

    strict_nulls: bool = True  # case 1 leaves stops without a status alone
    include_case_6: bool = False  # bins matched by case 6 alone move too
    mark_other_vehicle: bool = False  # cases 5 and 6 mark the stop
    keep_known_waste: bool = False  # an unknown waste weight counts as 0
    carry_positions: bool = False  # the first ping of a vehicle has a segment from its last position in earlier batches
    rules: SweepRules = CURRENT


class Batch:
    """``fleet`` has the tables as attributes, ``pings`` among them.

    ``now`` dates the changes. Without it the frames are those of each step on
    the tables as given, which is what the single queries compare. ``history``
    stands for trips that ended before its clock; all pings must be later.
    """

    def __init__(self, fleet, choices: Choices = Choices(), now: dt.datetime | None = None, history: History | None = None):
        self.fleet = fleet
        self.choices = choices
        self.now = now
        self.history = history

    # ---- lifting ----

    @cached_property
    def lifts(self) -> DataFrame:
        return cut_lineage(lift_reads(self.fleet.pings, self.fleet.vehicles))

    @cached_property
    def hits(self) -> DataFrame:
        find = matching.tag_hits if self.history is None else self.history.hits
        return cut_lineage(find(self.lifts, self.fleet.stops, self.fleet.trips))

    @cached_property
    def matched_trips(self) -> DataFrame:
        """The trips that reads are matched to."""
        return self.fleet.trips if self.history is None else cut_lineage(self.history.trips(self.fleet.trips))

    def trip_days(self) -> list[dt.date]:
        """Days of the trips that ended before the batch and that its reads may be matched to."""
        ends = self.hits.select("end_trip")
        asked = self.lifts.select("vehicle_id").distinct()
        ends = ends.unionByName(self.matched_trips.join(asked, "vehicle_id", "left_semi").select("end_trip"))
        days = ends.where("end_trip is not null").select(F.to_date("end_trip").alias("day")).distinct()
        return [row["day"] for row in days.collect()]

    @cached_property
    def cases(self) -> DataFrame:
        return matching.match_lifts(self.lifts, self.hits, self.matched_trips, self.fleet.stop_summaries)

    @cached_property
    def matches(self) -> DataFrame:
        """Cases with the columns of their read."""
        return cut_lineage(matching.with_ping(self.cases, self.lifts))

    @cached_property
    def lift_contexts(self) -> DataFrame:
        return cut_lineage(lifting.trip_lift_context(self.matches, self.fleet))

    @cached_property
    def waste(self) -> DataFrame:
        fleet = self.fleet
        return lifting.waste_per_trip(
            lifting.waste_records(self.matches, fleet.trip_summaries, fleet.vehicles, fleet.vehicle_types)
        )

    @cached_property
    def added_stops(self) -> DataFrame:
        """Stops of cases 3 and 4."""
        fleet = self.fleet
        bins = fleet.bins if self.now is None else self.moved_bins
        return cut_lineage(lifting.off_plan_stops(self.matches, bins, fleet.streets, fleet.stops, fleet.trips))

    # ---- sweeping ----

    @cached_property
    def locations(self) -> DataFrame:
        near = sweeping.street_proximity(sweep_reads(self.fleet.pings), self.fleet)
        return cut_lineage(near) if self.choices.carry_positions else near

    @cached_property
    def totals(self) -> DataFrame:
        before = self.fleet.last_positions if self.choices.carry_positions else None
        return cut_lineage(sweeping.driven_streets(self.locations, self.choices.rules, before))

    @cached_property
    def streets(self) -> DataFrame:
        return sweeping.street_completion(sweeping.street_distances(self.totals))

    # ---- roll-up ----

    @cached_property
    def plan_results(self) -> DataFrame:
        return cut_lineage(rollup.plan_summary(self.lift_contexts, self.swept))

    @cached_property
    def levels(self) -> dict[str, DataFrame]:
        return rollup.roll_up(self.plan_results, self.fleet, cut_lineage)

    # ---- new rows and changed rows ----

    @cached_property
    def changed_stop_summaries(self) -> DataFrame:
        """Summaries touched by a lift or a sweep, in the order lifts, new stops, sweep."""
        before = self.fleet.stop_summaries
        lifted = self.matches.where("summary_id is not null").select(F.col("summary_id").alias("id"))
        if self.choices.mark_other_vehicle:
            other = self.matches.where("case_no in (5, 6)").select("stop_id")
            lifted = lifted.unionByName(before.join(other, "stop_id", "left_semi").select("id"))
        touched = lifted.unionByName(self.streets.select(F.col("stop_summary_id").alias("id")))
        rows = before.join(touched, "id", "left_semi")
        rows = lifting.lift_state_case1(rows, self.matches, self.choices.strict_nulls)
        rows = lifting.lift_state_case2(rows, self.matches)
        staged = lifting.off_plan_summaries(self.added_stops, before.schema["id"].dataType)
        rows = rows.unionByName(lifting.missing_summaries(staged, before), allowMissingColumns=True)
        if self.choices.mark_other_vehicle:
            for case_no in (5, 6):
                rows = lifting.lift_state_other_vehicle(rows, self.matches, case_no)
        return cut_lineage(sweeping.street_state(rows, self.streets))

    @cached_property
    def swept(self) -> DataFrame:
        """Swept trips on the stop summaries as the batch leaves them."""
        unchanged = self.fleet.stop_summaries.join(self.changed_stop_summaries.select("id"), "id", "left_anti")
        after = unchanged.unionByName(self.changed_stop_summaries, allowMissingColumns=True)
        return cut_lineage(sweeping.swept_trips(self.streets, after, self.fleet))

    @cached_property
    def moved_bins(self) -> DataFrame:
        """Bins of the tags read, moved; new stops are set on these."""
        rows = self.fleet.bins.withColumn("tag_key", tag_key(F.col("tag")))
        rows = rows.join(self.matches.select("tag_key"), "tag_key", "left_semi").drop("tag_key")
        return cut_lineage(
            lifting.bin_location_update(rows, self.matches, self.choices.include_case_6, self.now)
        )

    @cached_property
    def changed_streets(self) -> DataFrame:
        tags = self.matches.where("case_no = 1").select("tag_key")
        rows = self.fleet.streets.withColumn("tag_key", tag_key(F.col("tag")))
        rows = rows.join(tags, "tag_key", "left_semi").drop("tag_key")
        return lifting.geometry_location_update(rows, self.matches, self.now)

    @cached_property
    def changed_trip_summaries(self) -> DataFrame:
        touched = self.lift_contexts.select(F.col("trip_summary_id").alias("id")).unionByName(
            self.swept.select(F.col("trip_summary_id").alias("id"))
        )
        rows = self.fleet.trip_summaries.join(touched, "id", "left_semi")
        rows = lifting.lift_trip_state(
            rows, self.lift_contexts, self.matches, self.waste, self.choices.keep_known_waste
        )
        return sweeping.sweep_trip_state(rows, self.swept, self.totals)

    def changed_log(self) -> DataFrame:
        """The log rows of the day after seeding, merging the plans seen and writing the percentages."""
        log, now, day = self.fleet.service_log, self.now, self.now.date()
        seeds = service_log.seed_rows(log, self.fleet, day, now)
        log = log.where(F.col("created_date") == F.lit(day)).unionByName(seeds, allowMissingColumns=True)
        seen = service_log.plan_rows(self.lift_contexts, sweeping.seen_plans(self.totals, self.fleet))
        return rollup.log_percentages(cut_lineage(service_log.upsert(log, seen, day, now)), self.levels, day)

    def changes(self) -> dict[str, DataFrame]:
        """Rows every table takes from this batch: changed ones of keyed tables, new ones of the others.

        Needs ``now``.
        """
        fleet, levels = self.fleet, self.levels
        carried = {"last_positions": sweeping.last_positions(self.locations, fleet.last_positions)} if self.choices.carry_positions else {}
        stop_columns = [name for name in fleet.stops.columns if name in self.added_stops.columns]
        return carried | {
            "tag_references": new_tag_references(self.lifts, fleet.tag_references).drop("tag_key"),
            "bins": lifting.bin_last_completion(self.moved_bins, self.matches),
            "streets": self.changed_streets,
            "stops": self.added_stops.select(*stop_columns),
            "stop_summaries": self.changed_stop_summaries,
            "trip_summaries": self.changed_trip_summaries,
            "latest_tag_events": lifting.latest_tag_events(self.matches, fleet.bins, fleet.vehicles),
            "outside_scope_events": lifting.outside_scope_events(
                self.matches, fleet.bins, fleet.vehicles, fleet.contract_types
            ),
            "tag_violations": lifting.tag_location_violations(
                self.lifts, self.matches, fleet.tag_references, fleet.bins, fleet.tag_violations
            ),
            "plans": levels["plans"].join(
                self.plan_results.select(F.col("plan_id").alias("id")), "id", "left_semi"
            ),
            "services": levels["services"].join(
                levels["service_pct"].select(F.col("service_id").alias("id")), "id", "left_semi"
            ),
            "contract_groups": levels["contract_groups"],
            "contracts": levels["contracts"],
            "service_log": self.changed_log(),
        }

    def all_levels(self) -> DataFrame:
        """Completion of every level touched: level, id, pct. A trip with both services shows the sweep."""

        def ident(*names: str):
            return F.concat_ws("/", *(F.col(name).cast("string") for name in names))

        lifted = self.lift_contexts.select("trip_id", at_most_hundred(F.col("trip_pct").cast("double")).alias("lift_pct"))
        swept = self.swept.select("trip_id", "trip_pct", F.lit(True).alias("is_swept"))
        trips = swept.join(lifted, "trip_id", "full").withColumn(
            "pct", F.when(F.col("is_swept"), F.col("trip_pct")).otherwise(F.col("lift_pct"))
        )
        levels = self.levels
        parts = [
            ("street", self.streets, ident("stop_summary_id", "vehicle_type", "company_type"), "completion"),
            ("trip", trips, ident("trip_id"), "pct"),
            ("plan", levels["plan_pct"], ident("plan_id"), "plan_pct"),
            ("service", levels["service_pct"], ident("service_id"), "service_pct"),
            ("group", levels["group_pct"], ident("contract_id", "group_id"), "group_pct"),
            ("contract", levels["contract_pct"], ident("contract_id"), "contract_pct"),
        ]
        frames = [
            df.select(F.lit(name).alias("level"), key.alias("id"), F.col(pct).alias("pct"))
            for name, df, key, pct in parts
        ]
        return reduce(DataFrame.unionByName, frames)
