"""Exact dedup (1) by content-defined chunk recipes, in DataFrame functions only.

A text without white space is cut where its own characters say so: a chunk ends
at the first sentence mark after ``LEAST`` characters, at ``MOST`` at the latest.
Each distinct chunk text moves once, to be checked against the others with its
fingerprint: a fingerprint that stands for one text only is a verified
identifier. Texts that share a fingerprint are told apart by an ordinal. After
that only lists of identifiers move: equal lists are equal texts.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.sources.staging import staged

LEAST, MOST = 200, 2000
CHUNK = f"(?s).{{{LEAST},{MOST - 1}}}?[.!?\\u3002]|.{{1,{MOST}}}"
WHITE = " \t\n\x0b\x0c\r"


def normalised(text):
    """A text column, null as empty, without the six ASCII white-space characters."""
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def chunks(text):
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _clashes(docs, fingerprint):
    """Of chunk texts that share a fingerprint, all but the first: (fingerprint, chunk, ordinal)."""
    store = (
        docs.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
        .select(fingerprint("chunk").alias("fp"), "chunk")
        .groupBy("fp", "chunk")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    shared = staged(
        store.groupBy("fp").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("fp"), "clashes"
    )
    if shared.isEmpty():
        return None
    order = Window.partitionBy("fp").orderBy("chunk")
    return (
        store.join(shared, "fp", "left_semi")
        .select("fp", "chunk", (F.row_number().over(order) - 1).alias("ordinal"))
        .where("ordinal > 0")
    )


def recipes(df, text="text", key="doc_id", fingerprint=F.xxhash64):
    """One row per row of ``df``: doc_id, row, n_points, text_sha256 and its list of verified chunk
    identifiers, ``recipe`` with ``ordinals`` for the places where a fingerprint stands for several texts.
    """
    docs = df.select(
        F.col(key).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_points"),
        normalised(F.col(text)).alias("norm"),
    )
    base = staged(
        docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "n_points",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform(chunks(F.col("norm")), lambda c: fingerprint(c)).alias("recipe"),
        ),
        "recipes",
    )
    clashes = _clashes(docs, fingerprint)
    if clashes is None:
        return base.withColumn("ordinals", F.expr("cast(array() as array<struct<place: int, ordinal: int>>)"))
    fixes = (
        docs.select(F.sha2("norm", 256).alias("text_sha256"), F.posexplode(chunks(F.col("norm"))).alias("place", "chunk"))
        .withColumn("fp", fingerprint("chunk"))
        .join(clashes, ["fp", "chunk"])
        .groupBy("text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct("place", "ordinal"))).alias("ordinals"))
    )
    return base.join(fixes, "text_sha256", "left").withColumn(
        "ordinals",
        F.coalesce("ordinals", F.expr("cast(array() as array<struct<place: int, ordinal: int>>)")),
    )


def exact_groups(df, text="text", key="doc_id", fingerprint=F.xxhash64):
    """Each row with the row of its group that stays: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Texts are equal when they are so without white space; null text is empty, and
    empty texts are one group. The longest original stays, then the smallest key;
    a null key comes last. Of repeated rows one is kept. Other columns do not matter.
    """
    rows = recipes(df, text, key, fingerprint)
    groups = rows.groupBy("recipe", "ordinals").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias(
            "stays"
        ),
    )
    # written first: a join that reads an aggregate of its own key is not split where one text has very many rows
    groups = staged(groups, "groups")
    return rows.join(groups.hint("merge"), ["recipe", "ordinals"]).select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        "text_sha256",
        "n_points",
    )


def kept_rows(df, text="text", key="doc_id"):
    """The rows of ``df`` that stay, with all their columns."""
    kept = exact_groups(df, text, key).where("kept").select(
        F.col("doc_id").alias("_key"), F.col("text_sha256").alias("_sha"), F.col("n_points").alias("_n")
    )
    kept = staged(kept, "kept")
    marked = df.select(
        *df.columns,
        F.sha2(normalised(F.col(text)), 256).alias("_own"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("_length"),
    )
    out = marked.join(
        kept,
        F.col(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_sha")) & (F.col("_length") == F.col("_n")),
        "left_semi",
    )
    if df.groupBy(key).count().where("count > 1").isEmpty():
        return out.drop("_own", "_length")
    # repeated rows of a key have equal texts here; the first of them stays
    first = Window.partitionBy(key, "_own").orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in df.columns])
    return out.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_own", "_length", "_place")
