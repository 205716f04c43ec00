"""Tag models: each turns (level-5 rules, source rows) into ``(userId, tagsId)``.

A model names its level-4 tag id and how to compute; the runner
(``tagloom.plans.runner``) supplies the rules and the source the tag's
rule points at, then merges or replaces the result in the store.

User-defined models subclass ``TagModel`` and implement ``compute``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import age_years, epoch_to_long, shifted_days_since
from tagloom.functions.rules import range_rules
from tagloom.functions.user import SumAggregate
from tagloom.operators.aggregate import last_per_key, rfe_measures
from tagloom.operators.broadcast import maybe_broadcast
from tagloom.operators.match import exact_match, range_match


@dataclass
class TagModel:
    """Base: ``tag_id`` is the level-4 tag; ``mode`` is ``merge`` or ``replace``."""

    tag_id: int
    mode: str = "merge"

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def per_key(self) -> Column | None:
        """What the model needs of all rows of a key, as one aggregate; None if it needs the rows."""
        return None

    def compute_per_key(self, rules: DataFrame, values: DataFrame) -> DataFrame:
        """New tags from ``(userId, __value)``, the aggregate of ``per_key`` (for models that have one)."""
        raise TypeError(f"{type(self).__name__} has no aggregate")


@dataclass
class ExactMatchModel(TagModel):
    """Tag = the level-5 child whose rule text equals the source value."""

    key_field: str = "id"
    value_field: str = "value"
    on_unmatched: str = "error"

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        return exact_match(source, rules, self.value_field, self.key_field, self.on_unmatched)

    def per_key(self) -> Column | None:
        # the distinct values of a key; only where a null value changes nothing
        return F.collect_set(F.col(self.value_field).cast("string")) if self.on_unmatched == "drop" else None

    def compute_per_key(self, rules: DataFrame, values: DataFrame) -> DataFrame:
        each = values.select("userId", F.explode("__value").alias("__v"))
        return exact_match(each, rules, "__v", "userId", self.on_unmatched)


@dataclass
class RecencyRangeModel(TagModel):
    """Purchase cycle: days from the last event to ``as_of - shift_days``,
    tagged by the range rule (``"start-end"``) that holds it.

    ``compute_detail`` returns ``userId, days, tagsId, start, end``; users
    whose days fall in no range (e.g. negative: an event inside the shift
    window) get no row.
    """

    key_field: str = "memberId"
    time_field: str = "finishTime"
    shift_days: int = 30
    as_of: str | None = None

    def days(self, source: DataFrame) -> DataFrame:
        return self._days(last_per_key(source, self.key_field, self.time_field))

    def _days(self, last: DataFrame) -> DataFrame:
        return last.select(
            "userId", shifted_days_since(F.col("maxFinishTime"), self.as_of, self.shift_days).cast("int").alias("days")
        )

    def compute_detail(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        return self._match(rules, self.days(source))

    def _match(self, rules: DataFrame, days: DataFrame) -> DataFrame:
        # validated inside range_match's measuring pass (one small job, not two)
        m = range_match(days, range_rules(rules, validate=False), "days")
        return m.select("userId", "days", F.col("tagsId").cast("string").alias("tagsId"), "start", "end")

    def per_key(self) -> Column | None:
        return F.max(epoch_to_long(F.col(self.time_field)))

    def compute_per_key(self, rules: DataFrame, values: DataFrame) -> DataFrame:
        last = values.withColumnRenamed("__value", "maxFinishTime")
        return self._match(rules, self._days(last)).select("userId", "tagsId")

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        return self.compute_detail(rules, source).select("userId", "tagsId")


@dataclass
class AgeRangeModel(TagModel):
    """Extension (the reference reads rules and source but computes nothing):
    completed years at ``as_of`` from a birthday field, tagged by range rule."""

    key_field: str = "id"
    birthday_field: str = "birthday"
    as_of: str | None = None

    def compute_detail(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        ages = source.select(
            F.col(self.key_field).cast("string").alias("userId"),
            age_years(F.col(self.birthday_field), self.as_of).alias("age"),
        )
        m = range_match(ages, range_rules(rules, validate=False), "age")
        return m.select("userId", "age", F.col("tagsId").cast("string").alias("tagsId"))

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        return self.compute_detail(rules, source).select("userId", "tagsId")


@dataclass
class UserFunctionModel(TagModel):
    """Tag = the range rule that holds what a user's own aggregate makes of a user's rows."""

    key_field: str = "id"
    aggregate: SumAggregate | None = None

    def compute_detail(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        key = F.col(self.key_field).cast("string").alias("userId")
        values = self.aggregate.per_key(source, key, "value")
        m = range_match(values, range_rules(rules, validate=False), "value")
        return m.select("userId", "value", F.col("tagsId").cast("string").alias("tagsId"))

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        return self.compute_detail(rules, source).select("userId", "tagsId")


@dataclass
class ActivityModel(TagModel):
    """Extension (declared only in the reference): R/F/E activity measures,
    k-means on them, clusters ranked by (low R, high F, high E) and paired
    in that order with the level-5 children sorted by their rule (a rank
    number).  The pairing is our choice; cluster ids themselves are
    arbitrary."""

    key_field: str = "global_user_id"
    time_field: str = "log_time"
    action_field: str = "loc_url"
    as_of: str | None = None
    lookback_days: int = 30
    k: int = 4
    seed: int = 7

    def measures(self, source: DataFrame) -> DataFrame:
        return rfe_measures(
            source, self.key_field, self.time_field, self.action_field, self.as_of, self.lookback_days
        )

    def compute(self, rules: DataFrame, source: DataFrame) -> DataFrame:
        from tagloom.operators.cluster import cluster_rfe

        clustered = cluster_rfe(self.measures(source), k=self.k, seed=self.seed)
        ranked_rules = rules.select(
            F.col("id").cast("string").alias("tagsId"), F.col("rule").cast("int").alias("rank")
        )
        ranked_rules, _ = maybe_broadcast(ranked_rules)
        return clustered.join(ranked_rules, "rank", "left").select("userId", "tagsId")
