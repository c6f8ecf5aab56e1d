"""Referrals from the CSV extract, folded into the same history as the operational ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.functions.predicates import differs_null_as_empty
from chronostar.operators.scd2 import CLOSED, KEPT, OPENED, STATE, closed_version, columns, kept_version, opened_version
from chronostar.plans.entities import USER_TRAFFIC, Batch
from chronostar.session import stage

KEY = ["user_id", "source_id", "referred_at"]
SEQ = "_seq"  # position of a CSV row in its extract; breaks ties between repeated keys
PASS = "_pass"  # 0: key was unknown, 1: next version of a known key


def union_sources(operational: DataFrame, extract: DataFrame) -> DataFrame:
    """Referrals of both sources in one frame, tagged by who delivered them (1, 2)."""
    cols = [*KEY, "campaign_code"]
    return operational.select(*cols, F.lit(1).alias("source_id_audit")).unionByName(
        extract.select(*cols, F.lit(2).alias("source_id_audit"))
    )


def _first(rows: DataFrame, value: tuple[str, ...], order: str, name: str) -> DataFrame:
    """First row per key; partial aggregation keeps repeated keys from piling up."""
    return rows.groupBy(*KEY).agg(F.min_by(F.struct(*value), F.col(order)).alias(name))


def merge_extract(
    extract: DataFrame,
    active: DataFrame,
    users: DataFrame,
    sources: DataFrame,
    batch: Batch,
    path: str | None = None,
) -> DataFrame:
    """Fold one CSV extract into the open referrals, in set form.

    ``extract`` carries a ``_seq`` column giving the row order. The effect is that
    of taking its rows one after the other:

    * rows whose key has no open referral are all inserted, repeats included;
    * then the first row of a key that differs in campaign from the key's oldest
      open referral closes every open referral of that key and becomes the next
      version. Later rows of that key find nothing open and do nothing.

    Keys match through any version of the user and source (the business keys are
    carried on the stored rows); inserts need an open user and source, so a
    referral of a deleted user can be closed without a successor.
    """
    entity = USER_TRAFFIC

    # Intermediate tables are written: each then meets the next join as a plain
    # scan of known size, so it is broadcast if small, and a key that repeats on
    # the other side is split (an aggregate between shuffle and join prevents that).
    def written(df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, f"{path}/{name}" if path else None)

    keyed = written(
        extract.join(users.select("user_id", "user_sk"), "user_id", "left").join(
            sources.select("source_id", "traffic_source_sk"), "source_id", "left"
        ),
        "keyed",
    )
    insertable = F.col("user_sk").isNotNull() & F.col("traffic_source_sk").isNotNull()
    keys = written(keyed.select(*KEY).distinct(), "keys")
    met = active.select(*KEY, entity.sk, "campaign_code").join(keys, KEY, "left_semi")
    known = _first(met, ("campaign_code",), entity.sk, "_known")
    # Of an unknown key the first inserted row is open from here on and stands for it.
    first_new = _first(keyed.filter(insertable), ("campaign_code",), SEQ, "_first_new")
    standing = written(first_new.join(known, KEY, "full_outer"), "standing")
    rows = keyed.join(standing, KEY, "left")

    inserted = rows.filter(F.col("_known").isNull() & insertable)
    campaign = F.coalesce("_known", "_first_new")
    differs = differs_null_as_empty(F.col("campaign_code"), campaign["campaign_code"])
    acting = written(
        _first(
            rows.filter(campaign.isNotNull() & differs),
            ("campaign_code", "user_sk", "traffic_source_sk", SEQ),
            SEQ,
            "_act",
        ),
        "acting",
    )
    hits = acting.select(*KEY, F.lit(True).alias("_hit"))

    # Referrals open before this extract: closed where a row acts on their key.
    w = active.select(*KEY, F.struct(*entity.stored_schema.names).alias("w")).join(hits, KEY, "left")
    kept, closed = kept_version(entity), closed_version(entity, batch)
    before = w.select(
        *[F.when(F.col("_hit"), closed[n]).otherwise(kept[n]).alias(n) for n in kept],
        F.when(F.col("_hit"), CLOSED).otherwise(KEPT).alias(STATE),
    )

    def opened(df: DataFrame, number: int) -> DataFrame:
        packed = df.select(F.struct(*entity.payload).alias("s"), "_end", SEQ)
        version = columns(opened_version(entity, batch, ended=F.col("_end")))
        return packed.select(*version, F.lit(OPENED).alias(STATE), F.lit(number).alias(PASS), SEQ)

    fresh = inserted.join(hits, KEY, "left").withColumn("_end", F.coalesce("_hit", F.lit(False)))
    successor = acting.select(*KEY, "_act.*").filter(insertable).withColumn("_end", F.lit(False))
    return opened(fresh, 0).unionByName(opened(successor, 1)).unionByName(before, allowMissingColumns=True)


def partial_key_matches(source: DataFrame, active: DataFrame) -> DataFrame:
    """Versions the timestamp-only comparison would insert for each operational referral.

    Comparing referrals by ``referred_at`` alone pairs every source row with every
    open referral of that instant. The pairs are never built: the number with
    another campaign is all of the instant minus those with the same campaign.
    """
    campaign = F.coalesce("campaign_code", F.lit(""))
    per_campaign = active.groupBy("referred_at", campaign.alias("_campaign")).agg(F.count(F.lit(1)).alias("_same"))
    per_campaign = stage(per_campaign, "per-campaign")  # so that a crowded instant of the source is split
    per_instant = stage(per_campaign.groupBy("referred_at").agg(F.sum("_same").alias("_all")), "per-instant")
    counted = (
        source.withColumn("_campaign", campaign)
        .join(per_instant, "referred_at")
        .join(per_campaign, ["referred_at", "_campaign"], "left")
        .withColumn("versions", F.col("_all") - F.coalesce("_same", F.lit(0)))
    )
    return counted.filter("versions > 0").select(
        "user_sk", "traffic_source_sk", "referred_at", "campaign_code", "versions"
    )
