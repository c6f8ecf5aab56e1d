"""Type-2 history: classify source rows against the open versions and merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronostar.functions.predicates import differs_null_as_empty, is_active, is_distinct_from
from chronostar.plans.entities import NULL_SAFE, Batch, Entity
from chronostar.schemas import open_end, timestamp

# Fate of a row in the next snapshot.
KEPT, CLOSED, OPENED = "kept", "closed", "opened"
STATE = "row_state"
#: What a source row or an open version can be in a merge, besides unchanged.
CLASSES = ("new", "changed", "missing")
TIE = "_tie"  # the replaced version; tells apart successors of one key that are equal otherwise


def denormalise_courses(courses: DataFrame, categories: DataFrame, subcategories: DataFrame) -> DataFrame:
    """Replace the category keys of a course by the names.

    The subcategory is found by its own key alone, so a course whose category
    and subcategory disagree is kept.
    """
    return (
        courses.join(categories.select("category_id", F.col("name").alias("category")), "category_id")
        .join(subcategories.select("subcategory_id", F.col("name").alias("sub_category")), "subcategory_id")
        .drop("category_id", "subcategory_id")
    )


def changed(entity: Entity, left: str = "s", right: str = "w") -> Column:
    """True where any tracked column differs."""
    tests = []
    for name, mode in entity.tracked.items():
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        tests.append(is_distinct_from(a, b) if mode == NULL_SAFE else differs_null_as_empty(a, b))
    return reduce(or_, tests)


def _version(entity: Entity, side: str, **values: Column) -> dict[str, Column]:
    """Stored history columns taken from one side of a pair, some of them replaced."""
    return {
        f.name: (values[f.name] if f.name in values else F.col(f"{side}.{f.name}")).cast(f.dataType)
        for f in entity.stored_schema
    }


def opened_version(entity: Entity, batch: Batch, ended: Column | None = None) -> dict[str, Column]:
    """A new version of source row ``s``; its surrogate key is still to come.

    Where ``ended`` is true the version already ends in the batch that opens it.
    """
    end, update = open_end(), F.lit(None)
    if ended is not None:
        end = F.when(ended, timestamp(batch.ts)).otherwise(end)
        update = F.when(ended, F.lit(batch.batch_id))
    audit = {
        entity.sk: F.lit(None),
        "start_date": timestamp(batch.ts),
        "end_date": end,
        entity.audit: F.lit(batch.audit),
        "insert_id": F.lit(batch.batch_id),
        "update_id": update,
    }
    return _version(entity, "s", **audit)


def kept_version(entity: Entity) -> dict[str, Column]:
    """Open version ``w`` as it is."""
    return _version(entity, "w")


def closed_version(entity: Entity, batch: Batch) -> dict[str, Column]:
    """Open version ``w`` ending in this batch."""
    return _version(entity, "w", end_date=timestamp(batch.ts), update_id=F.lit(batch.batch_id))


def columns(version: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in version.items()]


def initial_rows(source: DataFrame, entity: Entity, batch: Batch, *keep: str) -> DataFrame:
    """Every source row becomes an open version."""
    rows = source.select(F.struct(*entity.payload).alias("s"), *keep)
    return rows.select(*columns(opened_version(entity, batch)), *keep)


def unrepeated(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The source, failing when a key comes twice (the operational tables declare it unique).

    Numbers the rows of a key in the partitioning and order the merge join needs
    anyway, so the check adds no shuffle and no sort.
    """
    repeat = F.row_number().over(W.partitionBy(*key).orderBy(*key)) > 1
    checked = source.withColumn("_repeat", repeat)
    message = F.concat(F.lit(f"repeated source key {', '.join(key)}: "), F.to_json(F.struct(*key)))
    alarm = F.raise_error(message).cast("boolean")
    return checked.filter(F.when(F.col("_repeat"), alarm).otherwise(True)).drop("_repeat")


def _pair(source: DataFrame, active: DataFrame, entity: Entity) -> DataFrame:
    """Source rows (``s``) beside the open versions (``w``) of the same key."""
    if entity.unique_active:
        source = unrepeated(source, entity.key)
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in entity.key], F.struct(*entity.payload).alias("s"))
    w = active.select(
        *[F.col(k).alias(f"_w_{k}") for k in entity.key], F.struct(*entity.stored_schema.names).alias("w")
    )
    on = [F.col(f"_s_{k}") == F.col(f"_w_{k}") for k in entity.key]
    if entity.unique_active:
        # Both sides hold a key once, so one shuffle per side settles every class
        # and no partition can be skewed by a repeated key.
        return s.join(w, on, "full_outer").select("s", "w")
    # A key may have many open versions. Full outer joins cannot be split on
    # skew; a left join from the versions and an anti join can, as long as the
    # shuffled sides go straight into the join (so no check on the way there).
    seen = w.join(s, on, "left").select("s", "w")
    unseen = s.join(w.select(*[f"_w_{k}" for k in entity.key]).distinct(), on, "left_anti").select(
        "s", F.lit(None).cast(seen.schema["w"].dataType).alias("w")
    )
    return seen.unionByName(unseen)


def classify(source: DataFrame, active: DataFrame, entity: Entity) -> DataFrame:
    """Pairs of source row and open version with a ``class`` column.

    new: no open version; missing: open version without a source row;
    changed / unchanged: both, by the tracked columns.
    """
    klass = (
        F.when(F.col("w").isNull(), "new")
        .when(F.col("s").isNull(), "missing")
        .when(changed(entity), "changed")
        .otherwise("unchanged")
    )
    return _pair(source, active, entity).withColumn("class", klass)


def merge_rows(source: DataFrame, active: DataFrame, entity: Entity, batch: Batch) -> DataFrame:
    """All rows of the next snapshot that this merge touches or keeps, with their fate.

    One pass gives the untouched open versions (``kept``), the versions ending
    now (``closed``) and the versions beginning now without a surrogate key
    (``opened``). A closed key that comes back is simply new again.
    """
    return fates(classify(source, active, entity), entity, batch)


def fates(pairs: DataFrame, entity: Entity, batch: Batch, *keep: str) -> DataFrame:
    """The rows that classified pairs become, with their fate."""
    states = (
        F.when(F.col("class") == "new", F.array(F.lit(OPENED)))
        .when(F.col("class") == "missing", F.array(F.lit(CLOSED if entity.detect_deletes else KEPT)))
        .when(F.col("class") == "changed", F.array(F.lit(CLOSED), F.lit(OPENED)))
        .otherwise(F.array(F.lit(KEPT)))
    )
    rows = pairs.select("s", "w", F.explode(states).alias(STATE), *keep)
    new, ended, old = opened_version(entity, batch), closed_version(entity, batch), kept_version(entity)
    ending = ("end_date", "update_id")
    merged = []
    for name, value in old.items():
        if name in ending:
            value = F.when(F.col(STATE) == CLOSED, ended[name]).otherwise(value)
        merged.append(F.when(F.col(STATE) == OPENED, new[name]).otherwise(value).alias(name))
    tie = [] if entity.unique_active else [F.col(f"w.{entity.sk}").alias(TIE)]
    return rows.select(*merged, STATE, *tie, *keep)


def acting_pairs(source: DataFrame, active: DataFrame, entity: Entity) -> DataFrame:
    """The classified pairs that change the history: new, changed and, where deletes count, missing ones.

    The source may lack the parents' surrogate keys: classes follow from the business keys, which the
    versions carry. ``with_parents`` adds them to what is left.
    """
    lacking = [p.sk for p in entity.parents if p.sk not in source.columns]
    source = source.withColumns({sk: F.lit(None).cast("long") for sk in lacking})
    acting = ("new", "changed", "missing") if entity.detect_deletes else ("new", "changed")
    return classify(source, active, entity).filter(F.col("class").isin(*acting))


def with_parents(pairs: DataFrame, entity: Entity, parents: dict[str, DataFrame]) -> DataFrame:
    """Pairs whose source rows get the surrogate keys of their parents' open versions.

    A source row whose parent has no open version is as good as absent: a new one is left out,
    and a changed one leaves its version open. ``pairs`` must be written, so that their
    size decides the joins; they are the side that repeats a parent.
    """
    for p in entity.parents:
        lookup = parents[p.table].filter(is_active()).select(
            F.col(p.natural).alias("_natural"), F.col(p.sk).alias("_sk")
        )
        found = pairs.join(lookup, F.col(f"s.{p.natural}") == F.col("_natural"))
        pairs = found.withColumn("s", F.col("s").withField(p.sk, F.col("_sk"))).drop("_natural", "_sk")
    return pairs


def merge_summary(source: DataFrame, active: DataFrame, entity: Entity) -> DataFrame:
    """Number of pairs per class."""
    return (
        classify(source, active, entity)
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(entity.name).alias("table"), "class", "rows")
    )


# --- the single steps, for callers that want one class only -------------------


def new_rows(source: DataFrame, active: DataFrame, entity: Entity, batch: Batch) -> DataFrame:
    """Versions for keys without an open version."""
    fresh = source.join(active.select(*entity.key), list(entity.key), "left_anti")
    return initial_rows(fresh, entity, batch)


def _changed_pairs(source: DataFrame, active: DataFrame, entity: Entity) -> DataFrame:
    s, w = source.alias("s"), active.alias("w")
    on = [F.col(f"s.{k}") == F.col(f"w.{k}") for k in entity.key]
    return w.join(s, on).filter(changed(entity))


def changed_rows(source: DataFrame, active: DataFrame, entity: Entity, batch: Batch) -> DataFrame:
    """Next versions of keys whose tracked columns changed."""
    return initial_rows(_changed_pairs(source, active, entity).select("s.*"), entity, batch)


def closed_rows(source: DataFrame, active: DataFrame, entity: Entity, batch: Batch) -> DataFrame:
    """Versions that end because their source row changed."""
    return _changed_pairs(source, active, entity).select(*columns(closed_version(entity, batch)))


def deleted_rows(source: DataFrame, active: DataFrame, entity: Entity, batch: Batch) -> DataFrame:
    """Versions that end because their key left the source."""
    gone = active.join(source.select(*entity.key), list(entity.key), "left_anti")
    return gone.alias("w").select(*columns(closed_version(entity, batch)))
