"""Shards along a Hilbert curve over metadata, with DataFrame functions only.

Each dimension is quantised to `bits` bits; rows are ordered by their index on the
curve and the order is cut into runs of equal row counts. Rows that agree in most
dimensions are close on the curve, so each shard covers a small box of the metadata
space and filters on any dimension skip most shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.operators.keys import assign_keys
from chronostar.session import stage

BITS = 8
#: Steps of the size dimension for each doubling of the size.
STEPS = 8


def bin_of_size(size: Column, bits: int = BITS) -> Column:
    """Logarithmic bins; null falls into the first."""
    level = F.floor(F.log2(F.greatest(size, F.lit(1))) * STEPS).cast("int")
    return F.coalesce(F.least(level, F.lit((1 << bits) - 1)), F.lit(0))


def bin_of_name(name: Column, bits: int = BITS) -> Column:
    """A bin for each name, by hash; null has one as well."""
    return F.pmod(F.xxhash64(name), F.lit(1 << bits)).cast("int")


def _literals(pairs: Sequence[tuple[int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(q).alias("q")) for i, q in pairs])


def curve_index(dimensions: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve (long) of quantised dimensions (int, 0 to 2^bits - 1).

    Coordinates are turned into the transposed index by undoing the curve's rotations
    from the highest bit, then Gray-coded; the index takes their bits in turn.
    """
    n = len(dimensions)
    if n * bits > 62:
        raise ValueError("the index must fit into 62 bits")
    point = F.array(*[d.cast("int") for d in dimensions])

    def turn(x: Column, step: Column) -> Column:
        lower = step.q - 1
        own, head = F.get(x, step.i), F.get(x, F.lit(0))
        is_set = own.bitwiseAND(step.q) != 0
        swap = head.bitwiseXOR(own).bitwiseAND(lower)
        return F.transform(
            x,
            lambda v, j: F.when(is_set & (j == 0), v.bitwiseXOR(lower))
            .when(~is_set & ((j == 0) | (j == step.i)), F.when(step.i == 0, v).otherwise(v.bitwiseXOR(swap)))
            .otherwise(v),
        )

    turned = F.aggregate(_literals([(i, 1 << b) for b in range(bits - 1, 0, -1) for i in range(n)]), point, turn)
    grayed = F.aggregate(
        _literals([(i, 0) for i in range(1, n)]),
        turned,
        lambda x, s: F.transform(
            x, lambda v, j: F.when(j == s.i, v.bitwiseXOR(F.get(x, s.i - 1))).otherwise(v)
        ),
    ) if n > 1 else turned
    last = F.aggregate(
        _literals([(n - 1, 1 << b) for b in range(bits - 1, 0, -1)]),
        F.struct(grayed.alias("x"), F.lit(0).alias("t")),
        lambda a, s: F.struct(
            a.x.alias("x"),
            F.when(F.get(a.x, s.i).bitwiseAND(s.q) != 0, a.t.bitwiseXOR(s.q - 1)).otherwise(a.t).alias("t"),
        ),
        lambda a: F.transform(a.x, lambda v: v.bitwiseXOR(a.t)),
    ) if bits > 1 else grayed
    return F.aggregate(
        F.array(F.struct(last.alias("x"))),
        F.lit(0).cast("long"),
        lambda _, row: F.aggregate(
            _literals([(i, 1 << b) for b in range(bits - 1, -1, -1) for i in range(n)]),
            F.lit(0).cast("long"),
            lambda acc, s: acc * 2 + (F.get(row.x, s.i).bitwiseAND(s.q) != 0).cast("long"),
        ),
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, curve, law `rows`, shard, slot and grown_shard (null) of every row.

    Shards are runs of the order (curve index, checksum, key), so equal texts of one source
    and language lie side by side; their row counts differ by one at most. Sizes are UTF-8
    bytes plus 16; a null text has none and checksum 0. Null keys, sources and languages
    are values like others; repeated rows have slots of their own; an empty table gives
    no rows. The columns `lang` and `source` are dimensions where the table has them.
    """
    names = [c for c in ("lang", "source") if c in docs.columns]
    size = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))) + F.lit(16)
    crc = F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        F.col(key).alias("_key"),
        size.cast("long").alias("_size"),
        crc.cast("long").alias("_crc"),
        curve_index([bin_of_size(size), *[bin_of_name(F.col(c)) for c in names]]).alias("_curve"),
    )
    # Without the texts, so that sampling the bounds of the order doesn't read them again.
    ranked, last = assign_keys(stage(sized, "curve"), "_rank", ["_curve", "_crc", "_key"], start=-1)
    total = max(last + 1, 1)
    placed = ranked.withColumn("_shard", F.expr(f"_rank * {shards} div {total}"))
    return placed.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_curve").alias("curve"),
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - F.expr(f"(_shard * {total} + {shards - 1}) div {shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
