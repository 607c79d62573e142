"""Versions of several satellites at the time of each event (V9), by one pass over sorted rows."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.batch import in_order
from ledgerloom.operators.joins import small_side
from ledgerloom.sources.staging import staged

#: Staged bytes up to which the versions carried between parts are broadcast.
CARRIED_LIMIT = 2 * 1024 * 1024


def versions_at(events, moment, satellites, keys, valid_from="dv_valid_from", valid_to="dv_valid_to"):
    """V9: each event with the version of every satellite that was in force at its time, null where none was.

    ``satellites`` maps a name, which becomes a struct column, to a history whose
    versions of a key do not overlap; the day a version closes counts in. Events
    and versions are united and sorted by key and time over all tasks, and the
    last version is carried forward: no event meets a version it does not get.
    Time ranges of a key may lie in many tasks, so no key is too large for
    one: each part hands on its last versions, one row a part and key.
    Events without a moment get none; equal events all stay; a null key has versions like any other.
    """
    names = list(satellites)
    at = F.col(moment).cast("timestamp")
    event = events.select(
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)], at.alias("at"), F.lit(1).alias("kind"),
        F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("event"),
    )
    rows = [event]
    for name in names:
        history = satellites[name]
        rows.append(
            history.where(F.col(valid_from).isNotNull()).select(
                *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)],
                F.col(valid_from).cast("timestamp").alias("at"), F.lit(0).alias("kind"),
                F.struct(*[F.col(f"`{c}`") for c in history.columns]).alias(f"v_{name}"),
            )
        )
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    by = [f"key{i}" for i in range(len(keys))]
    placed = in_order(united, [*by, "at", "kind"], "timeline")
    last = [F.max_by(f"v_{n}", F.when(F.col(f"v_{n}").isNotNull(), F.col("place"))).alias(f"last_{n}") for n in names]
    ends = staged(placed.where("kind = 0").groupBy(*by, "part").agg(*last), "ends")
    # parts of a key that hold events only have to hand on what came before
    held = staged(placed.select(*by, "part").distinct(), "parts")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*by, "part"]]
    handed = held.join(ends.withColumnsRenamed({k: f"_{k}" for k in [*by, "part"]}), same, "left")
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(
        handed.select(
            *[F.col(k).alias(f"_{k}") for k in [*by, "part"]],
            *[F.last(f"last_{n}", ignorenulls=True).over(earlier).alias(f"before_{n}") for n in names],
        ),
        "carried",
    )
    own = Window.partitionBy(*by, "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = placed.select(
        "*", *[F.last(f"v_{n}", ignorenulls=True).over(own).alias(f"here_{n}") for n in names]
    ).where("kind = 1")
    both = here.join(small_side(carried, CARRIED_LIMIT), same, "left")

    def in_force(name):
        version = F.coalesce(f"here_{name}", f"before_{name}")
        closed = version[valid_to].isNotNull() & (F.col("at").cast("date") > version[valid_to].cast("date"))
        return F.when(F.col("at").isNotNull() & ~closed, version).alias(name)

    return both.select("event.*", *[in_force(n) for n in names])
