"""Survivor keys and golden records."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructType

from ledgerloom.operators.dedupe import consolidate
from ledgerloom.operators.joins import anti, semi, small_side
from ledgerloom.sources.staging import staged


def repoint(df, bridge, columns):
    """Ids replaced by their survivor's where the bridge maps them.

    The bridge counts with one row per key, and only where the key changes, so
    a frame neither grows nor meets rows that would not alter it.
    """
    moves = (
        bridge.where(F.col("from_key").isNotNull() & (F.col("from_key") != F.col("to_key")))
        .groupBy(F.col("from_key").alias("__from"))
        .agg(F.min("to_key").alias("__to"))
    )
    for column in [columns] if isinstance(columns, str) else columns:
        df = (
            df.join(small_side(moves), F.col(column) == F.col("__from"), "left")
            .withColumn(column, F.coalesce("__to", column))
            .drop("__from", "__to")
        )
    return df


def survivor_bridge(hub, matches):
    """Matched companies to their survivor, and all others to themselves.

    Hub rows that no match names have no ``from_key``.
    """
    pairs = matches.select(
        F.col("verified_dv_hashkey_company").alias("to_key"),
        F.col("dv_hashkey_company").alias("from_key"),
        "jurisdiction",
        "dv_recsrc",
    )
    named = pairs.select("jurisdiction", F.col("from_key").alias("dv_hashkey_company")).union(
        pairs.select("jurisdiction", F.col("to_key").alias("dv_hashkey_company"))
    )
    alone = anti(hub, named, ["jurisdiction", "dv_hashkey_company"], null_safe=False).select(
        F.col("dv_hashkey_company").alias("to_key"),
        "jurisdiction",
        "dv_recsrc",
        "dv_source_version",
    )
    return pairs.unionByName(alone, allowMissingColumns=True)


def golden_record(bridge, satellite, order, key="dv_hashkey_company", verified=None):
    """One record per survivor.

    The survivor's own values come first, its duplicates fill what it lacks;
    arrays unite and booleans add up. A survivor already in ``verified`` starts
    from that record instead of the satellite.
    """
    return _records(bridge, consolidate(satellite, [key], [F.col(c) for c in order]), key, verified)


def _records(bridge, folded, key, verified=None):
    """Records of the survivors of a bridge from one folded row per company."""
    columns = [f.name for f in folded.schema.fields if f.name not in (key, "jurisdiction")]
    survivors = bridge.select(F.col("to_key").alias("__to"), F.col("jurisdiction").alias("__j")).distinct()
    own = _tagged(survivors, folded, "__to", key, columns, 1)
    if verified is not None:
        done = _tagged(survivors, verified, "__to", key, columns, 0)
        own = anti(own, done, ["__to", "__j"]).unionByName(done)
    copies = bridge.where("from_key is not null and from_key <> to_key").select(
        F.col("to_key").alias("__to"), F.col("jurisdiction").alias("__j"), "from_key"
    ).distinct()
    filled = _tagged(copies, folded, "from_key", key, columns, 2).join(
        own.select("__to", "__j").distinct(), ["__to", "__j"], "left_semi"
    )
    rows = own.unionByName(filled)
    record = consolidate(
        rows, ["__to", "__j"], [F.col("__priority"), F.col("__member")], include=columns
    )
    return record.withColumnsRenamed({"__to": key, "__j": "jurisdiction"})


def _tagged(members, records, member_key, record_key, columns, priority):
    """Records of the members, with priority and member for ordering."""
    record = records.select(
        F.col(record_key).alias("__record"), F.col("jurisdiction").alias("__rj"), *columns
    )
    return members.join(
        record, (F.col(member_key) == F.col("__record")) & (F.col("__j") == F.col("__rj"))
    ).select(
        "__to", "__j", F.lit(priority).alias("__priority"), F.col("__record").alias("__member"),
        *columns,
    )


def fold_state(satellite, order, key="dv_hashkey_company"):
    """What a satellite's rows leave of each company, to be merged with that of later loads.

    Arrays keep their distinct elements and booleans whether any is true; any
    other column becomes a struct of its first non-null value (``value``) and the
    order key that it came with (``by``). A column named like the state's own is not allowed.
    """
    by = F.struct(*[F.col(c) for c in order])
    scalars = [f.name for f in satellite.schema.fields if f.name != key and _is_scalar(f)]
    seen = satellite.select(
        *[F.struct(F.when(F.col(f.name).isNotNull(), by).alias("by"), F.col(f.name).alias("value")).alias(f.name)
          if f.name in scalars else F.col(f.name) for f in satellite.schema.fields]
    )
    return _merged(seen, key)


def _is_scalar(field):
    return not isinstance(field.dataType, (ArrayType, BooleanType))


def _merged(states, key):
    """States of one company as one: the least order key wins, value by value."""
    chosen = [f for f in states.schema.fields if f.name != key]
    rules = {
        f.name: lambda c: F.struct(F.min(f"{c}.by").alias("by"), F.min_by(f"{c}.value", f"{c}.by").alias("value"))
        for f in chosen if isinstance(f.dataType, StructType)
    }
    return consolidate(states, [key], [], rules)


def state_rows(state, key="dv_hashkey_company"):
    """One folded row per company, as ``golden_record`` takes it from the whole satellite."""
    return state.select(
        *[F.col(f"{f.name}.value").alias(f.name) if isinstance(f.dataType, StructType) else F.col(f.name)
          for f in state.schema.fields]
    )


def golden_changes(state, bridge, load, moved, order, key="dv_hashkey_company"):
    """What a load of the satellite and a change of the bridge do to states and records.

    ``load`` are the satellite's new rows, ``moved`` the bridge rows (to_key,
    from_key, jurisdiction) that came or went, ``bridge`` the bridge as it is now.
    Gives the new states of the companies of the load, the new records of the
    survivors that either reaches, and the (key, jurisdiction) of all records
    that go: replaced ones and those of companies that survive no longer.
    The satellite's earlier rows are not read, only the states of companies
    that a reached survivor stands for; what reaches is hinted as a broadcast
    while it is small.
    """
    fresh = fold_state(load, order, key)
    loaded = staged(fresh.select(key), "loaded")
    old = semi(state, small_side(loaded), [key])
    changed = staged(_merged(old.unionByName(fresh), key), "states")
    now = anti(state, small_side(loaded), [key]).unionByName(changed)

    pairs = bridge.select("to_key", "from_key", "jurisdiction")
    arrived = small_side(loaded.select(F.col(key).alias("member")))
    to = [F.col("to_key").alias("survivor"), "jurisdiction"]
    by_member = [
        pairs.join(arrived, F.col(end) == F.col("member"), "left_semi").select(*to) for end in ("to_key", "from_key")
    ]
    by_match = [
        moved.where(F.col(end).isNotNull()).select(F.col(end).alias("survivor"), "jurisdiction") for end in ("to_key", "from_key")
    ]
    reached = staged(by_member[0].union(by_member[1]).union(by_match[0]).union(by_match[1]).distinct(), "reached")
    part = staged(
        pairs.alias("p").join(
            small_side(reached).alias("r"),
            (F.col("p.to_key") == F.col("r.survivor")) & F.col("p.jurisdiction").eqNullSafe(F.col("r.jurisdiction")), "left_semi",
        ),
        "reached-bridge",
    )
    members = staged(
        part.select(F.col("to_key").alias(key)).union(part.where("from_key is not null").select("from_key")).distinct(), "members"
    )
    records = _records(part, state_rows(semi(now, small_side(members), [key]), key), key)
    return changed, records, reached.select(F.col("survivor").alias(key), "jurisdiction")
