"""One row of each group of near copies, by row: keys may be null or repeated."""

from pyspark.sql import functions as F

from ledgerloom.llm.common import staged
from ledgerloom.operators.dedupe import first_per_key


def one_per_group(df, groups, sign, text="text", key="doc_id"):
    """The rows of ``df`` that stay: of each component the row with the smallest key, null last, then the smallest signature.

    ``groups`` has doc_id, sig and component of every row; ``sign(docs)`` gives doc_id and sig of
    documents (doc_id, text). A key whose rows all stay or all go decides for them; rows of other
    keys are signed anew and decided one by one, so no row goes for another row's key. Of rows equal in key
    and signature one stays. All columns are kept.
    """
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig")
    stays = staged(groups.groupBy("component").agg(F.min(own).alias("stay")), "stays")
    judged = groups.join(stays.hint("merge"), "component").withColumn("stays", own.eqNullSafe(F.col("stay")))
    judged = staged(judged.groupBy("doc_id", "sig").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")), "judged")
    by_key = judged.groupBy(F.col("doc_id").alias("_key")).agg(F.sum("n").alias("n"), F.max("stays").alias("stays"))
    by_key = staged(by_key.where("not stays or n > 1").select("_key", F.col("stays").alias("_mixed")), "keys")
    same = F.col(key).eqNullSafe(F.col("_key"))
    clear = df.join(by_key.select("_key").hint("merge"), same, "left_anti")
    mixed = by_key.where("_mixed")
    if mixed.isEmpty():
        return clear
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    some = df.join(mixed.hint("merge"), same, "left_semi").select(row, F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    some = staged(some.withColumn("id", F.monotonically_increasing_id()), "mixed")
    signed = sign(some.select(F.col("id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    signed = signed.select(F.col("doc_id").alias("id"), "sig")
    winners = staged(judged.where("stays").select(F.col("doc_id").alias("_key"), F.col("sig").alias("_sig")), "winners")
    own = some.select("id", "doc_id").join(signed, "id")
    own = own.join(winners.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_key")) & (F.col("sig") == F.col("_sig")), "left_semi")
    first = first_per_key(own, ["doc_id", "sig"], [F.col("id").asc()], complete=False).select("id")
    kept = some.join(staged(first, "first").hint("merge"), "id", "left_semi")
    return clear.unionByName(kept.select(*[F.col("row").getField(c).alias(c) for c in df.columns]))
