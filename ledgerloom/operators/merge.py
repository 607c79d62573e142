"""Table merges as plans: base and updates in, next state or changes out.

Parquet has no MERGE. An insert-only merge gives the rows to append, so the
base is read but never rewritten; the others give the next state, of which a
writer replaces only the touched partitions (see ``touched``).
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import with_hash_diff
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.frames import enforce_schema
from ledgerloom.operators.joins import anti, keys_equal, outer_compare, semi, small_side
from ledgerloom.sources.staging import staged

FEED = ("_change_type", "_commit_version", "_commit_timestamp")


@dataclass(frozen=True)
class Changes:
    """M8: what one merge does to a table: rows that stay, come in, and are replaced (``before`` by ``after``).

    The merge finds them from keys and hashes; payloads are read for changed
    keys only, and the change feed is these frames, so no two states are compared.
    """

    kept: DataFrame
    inserts: DataFrame
    before: DataFrame
    after: DataFrame

    def state(self):
        """The next state of the table."""
        return self.kept.unionByName(self.changed(), allowMissingColumns=True)

    def changed(self):
        """The rows that the next state has and the table had not."""
        return self.after.unionByName(self.inserts, allowMissingColumns=True)

    def staged(self):
        """The changes written, so that the table may be replaced before they are read."""
        return Changes(self.kept, *(staged(df, "changes") for df in (self.inserts, self.before, self.after)))

    def feed(self, version, committed=None):
        """The changes as ``change_feed`` gives them."""
        moment = F.current_timestamp() if committed is None else F.lit(committed).cast("timestamp")
        kinds = (("insert", self.inserts), ("update_preimage", self.before), ("update_postimage", self.after))
        named = [df.withColumn(FEED[0], F.lit(kind)) for kind, df in kinds]
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
        plain = [c for c in united.columns if c not in FEED]
        return united.select(
            *plain, FEED[0], F.lit(version).cast("bigint").alias(FEED[1]), moment.alias(FEED[2])
        )


def new_rows(base, updates, keys, order=(), null_safe=True):
    """M1 / M2 / M6: one row per key of those the base does not have."""
    fresh = updates if base is None else anti(updates, base, keys, null_safe)
    return first_per_key(fresh, keys, order)


def insert_only(base, updates, keys, order=(), null_safe=True):
    """M1 / M2 / M6: the next state of an insert-only table."""
    fresh = new_rows(base, updates, keys, order, null_safe)
    return fresh if base is None else base.unionByName(fresh, allowMissingColumns=True)


def satellite_rows(base, updates, schema, keys, parent=None, null_safe=True):
    """M4: rows to append to a satellite.

    Payload is cast to the contract and hashed; a row counts as known when a
    row with equal keys is there. ``parent`` is the hub hash, which belongs to
    the key so that equal attributes of two parents stay two rows.
    """
    hashed = with_hash_diff(enforce_schema(updates, schema))
    distinct_by = [parent, "dv_hashdiff"] if parent else ["dv_hashdiff"]
    distinct = first_per_key(hashed, distinct_by)
    known = list(dict.fromkeys([*keys, *([parent] if parent else [])]))
    return distinct if base is None else anti(distinct, base, known, null_safe)


def satellite(base, updates, schema, keys, parent=None):
    """M4: the next state of a satellite."""
    rows = satellite_rows(base, updates, schema, keys, parent)
    return rows if base is None else base.unionByName(rows, allowMissingColumns=True)


def upsert(base, updates, keys, order=(), keep=("created_at",), null_safe=True):
    """M3: next state; changed rows replaced but for ``keep``, missing ones added.

    A base row without hash counts as changed. Columns that only the updates
    have come in, null where a base row stays as it is.
    """
    if base is None:
        return with_hash_diff(first_per_key(updates, keys, order))
    return upsert_changes(base, updates, keys, order, keep, null_safe).state()


def upsert_changes(base, updates, keys, order=(), keep=("created_at",), null_safe=True):
    """M3 / M8: what an upsert changes; the base must have one row per key.

    Of the base only keys and hashes meet the updates' keys, which are
    broadcast while they are few; then the rows of changed keys are fetched.
    """
    incoming = staged(with_hash_diff(first_per_key(updates, keys, order)), "incoming")
    slim = base if "dv_hashdiff" in base.columns else base.withColumn("dv_hashdiff", F.lit(None).cast("string"))
    known = semi(slim.select(*keys, "dv_hashdiff"), small_side(incoming.select(*keys)), keys, null_safe)
    known = known.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("dv_hashdiff").alias("__hash"), F.lit(True).alias("__there"))
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__{k}")) if null_safe else F.col(k) == F.col(f"__{k}") for k in keys],
    )
    new = F.col("__there").isNull()
    tagged = incoming.join(staged(known, "known"), same, "left").where(new | ~F.col("dv_hashdiff").eqNullSafe(F.col("__hash")))
    tagged = staged(tagged.select(*incoming.columns, new.alias("__new")), "tagged")
    inserts, fresh = (tagged.where(c).drop("__new") for c in ("__new", "not __new"))
    reached = small_side(fresh.select(*keys))
    before = semi(base, reached, keys, null_safe)
    names = [*base.columns, *[name for name in incoming.columns if name not in base.columns]]
    taken = [c for c in incoming.columns if c not in base.columns or c not in (*keys, *keep)]
    both = before.alias("l").join(small_side(fresh).alias("r"), keys_equal("l", "r", keys, null_safe))
    after = both.select(*[F.col(f"{'r' if name in taken else 'l'}.{name}") for name in names])
    return Changes(anti(base, reached, keys, null_safe), inserts, before, after)


def scd2(base, updates, schema, keys, as_of, reopen=True, order=()):
    """M5: next state of a history-keeping satellite at the date ``as_of``.

    Of several rows of a key in one batch the first by ``order`` counts, so a
    key has one current version at most.
    A row whose payload equals the current version of its key changes nothing.
    Any other closes the current version on the day before and becomes current
    itself. With ``reopen=False`` a payload that was ever seen is never opened
    again.
    """
    if base is None:
        return _versions(updates, schema, keys, as_of, order)
    return scd2_changes(base, updates, schema, keys, as_of, reopen, order).state()


def _versions(updates, schema, keys, as_of, order):
    """One row per key of the updates, as a version that is current from ``as_of``."""
    day = F.lit(as_of).cast("date")
    hashed = with_hash_diff(
        enforce_schema(updates, schema), exclude=("created_at", "updated_at")
    )
    return first_per_key(hashed, keys, order).withColumns(
        {
            "dv_status": F.lit(1),
            "dv_valid_from": F.coalesce(F.col("dv_valid_from"), day)
            if "dv_valid_from" in hashed.columns
            else day,
            "dv_valid_to": F.lit(None).cast("date"),
        }
    )


def scd2_changes(base, updates, schema, keys, as_of, reopen=True, order=()):
    """M5 / M8: what ``scd2`` changes: versions it closes, before and after, and versions it opens."""
    incoming = staged(_versions(updates, schema, keys, as_of, order), "incoming")
    seen_by = [*keys, "dv_hashdiff"] if reopen else ["dv_hashdiff"]
    seen = (base.where("dv_status = 1") if reopen else base).select(*seen_by)
    known = semi(seen, small_side(incoming.select(*seen_by)), seen_by, null_safe=True)
    fresh = staged(anti(incoming, staged(known, "known"), seen_by).select(*base.columns), "fresh")
    arriving = small_side(fresh.select(*keys))
    current = F.col("dv_status").eqNullSafe(1)
    before = semi(base.where(current), arriving, keys, null_safe=True)
    after = before.withColumns(
        {"dv_status": F.lit(0).cast(base.schema["dv_status"].dataType), "dv_valid_to": F.date_sub(F.lit(as_of).cast("date"), 1)}
    )
    kept = base.where(~current).unionByName(anti(base.where(current), arriving, keys))
    return Changes(kept, fresh, before, after.select(*base.columns))


def valid_at(history, moment):
    """V9: the versions in force at a date."""
    moment = F.lit(moment).cast("date") if isinstance(moment, str) else moment
    return history.where(
        (F.col("dv_valid_from") <= moment)
        & (F.col("dv_valid_to").isNull() | (moment <= F.col("dv_valid_to")))
    )


def conditional_merge(base, updates, keys, clauses, null_safe=False, order=()):
    """M7: update-only merge; the first clause that holds sets its columns.

    ``clauses`` are (condition, {column: value}) over the aliases ``base`` and
    ``updates``; of several updates of a key the first by ``order`` counts.
    """
    joined = base.alias("base").join(
        first_per_key(updates, keys, order).withColumn("__hit", F.lit(True)).alias("updates"),
        keys_equal("base", "updates", keys, null_safe),
        "left",
    )
    hit = F.col("updates.__hit").isNotNull()
    taken = F.lit(False)
    changes = {name: [] for name in base.columns}
    for condition, values in clauses:
        applies = hit & F.coalesce(condition, F.lit(False)) & ~taken
        for name, value in values.items():
            changes[name].append((applies, value))
        taken = taken | (hit & F.coalesce(condition, F.lit(False)))
    return joined.select(
        *[
            reduce(
                lambda rest, change: F.when(change[0], change[1]).otherwise(rest),
                reversed(changes[name]),
                F.col(f"base.{name}"),
            ).alias(name)
            for name in base.columns
        ]
    )


def change_feed(before, after, keys, version, exclude=("created_at", "updated_at"), committed=None):
    """M8: changes between two states of a table, with images before and after.

    ``committed`` is the time of the commit, now by default.
    """
    moment = F.current_timestamp() if committed is None else F.lit(committed).cast("timestamp")
    both = outer_compare(
        with_hash_diff(before, "__hash", exclude), with_hash_diff(after, "__hash", exclude), keys
    )
    old, new = F.col("l"), F.col("r")
    kinds = (
        F.when(old.isNull(), F.array(F.struct(F.lit("insert").alias("kind"), new.alias("row"))))
        .when(new.isNull(), F.array(F.struct(F.lit("delete").alias("kind"), old.alias("row"))))
        .when(
            old["__hash"] != new["__hash"],
            F.array(
                F.struct(F.lit("update_preimage").alias("kind"), old.alias("row")),
                F.struct(F.lit("update_postimage").alias("kind"), new.alias("row")),
            ),
        )
    )
    return (
        both.select(F.explode(kinds).alias("change"))
        .select(
            "change.row.*",
            F.col("change.kind").alias("_change_type"),
            F.lit(version).cast("bigint").alias("_commit_version"),
            moment.alias("_commit_timestamp"),
        )
        .drop("__hash")
    )


def split_feed(feed, after_version=None):
    """M8: rows to upsert and rows to delete since a processed version."""
    seen = feed if after_version is None else feed.where(F.col("_commit_version") > after_version)
    plain = lambda df: df.drop(*FEED)
    return (
        plain(seen.where("_change_type in ('insert', 'update_postimage')")),
        plain(seen.where("_change_type = 'delete'")),
    )


def delete_where(base, condition):
    """rows for which the predicate is not true."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return base.where(~F.coalesce(condition, F.lit(False)))


def delete_keys(base, doomed, keys):
    """rows whose key is not listed."""
    return anti(base, doomed, keys, null_safe=False)


def update_by_case(base, rules):
    """Columns rewritten by (condition, value) lists, others kept."""
    def cased(name):
        value = F.col(name)
        for condition, replacement in reversed(rules.get(name, [])):
            value = F.when(condition, replacement).otherwise(value)
        return value.alias(name)

    return base.select(*[cased(name) for name in base.columns])


def state_as_of(table, load_ts):
    """An insert-only table as it was at a load timestamp."""
    return table.where(F.col("dv_loaddts") <= F.lit(load_ts).cast("timestamp"))


def without_version(table, source_version):
    """An insert-only table without one load."""
    return table.where(~F.col("dv_source_version").eqNullSafe(F.lit(source_version)))


def touched(base, updates, partition_columns):
    """The part of the base in partitions that the updates reach.

    The distinct partition values are few; the semi join becomes a partition
    filter at run time, and a dynamic overwrite replaces just these.
    """
    return semi(base, updates.select(*partition_columns).distinct(), partition_columns, True)
