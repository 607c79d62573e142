"""Customs code hierarchy with inherited descriptions and parents."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.functions.keys import audit_columns, hash_key
from ledgerloom.operators.joins import small_side


def hierarchy(codes, country_code, country_name, record_source, load_ts=None, source_version=None):
    """Codes of 2, 4, 6 and 8 digits with all descriptions down from the chapter.

    A level hangs below the one above by prefix; an eight-digit code without a
    six-digit parent hangs below its four-digit one. A branch that does not
    reach up to its chapter is left out. ``codes`` holds code and description.
    """
    plain = codes.select(
        F.col("code").alias("raw"),
        F.trim("code").alias("code"),
        F.regexp_replace("description", "[().]", "").alias("description"),
    )
    level = lambda n: plain.where(F.length("raw") == n).select(
        F.col("code").alias(f"code_{n}"), F.col("description").alias(f"desc_{n}")
    ).distinct()
    two, four, six, eight = level(2), level(4), level(6), level(8)
    under = lambda child, n, parent, m: child.join(
        small_side(parent), F.substring(f"code_{n}", 1, m) == F.col(f"code_{m}")
    )
    fours = under(four, 4, two, 2)
    sixes = under(six, 6, fours, 4)
    direct = under(eight, 8, sixes, 6)
    has_six = sixes.select("code_4").distinct()
    # An eight-digit code falls back to its four-digit parent only where that
    # parent has no six-digit children at all.
    bare = fours.join(small_side(has_six), "code_4", "left_anti").select(*fours.columns)
    fallback = under(eight, 8, bare, 4).withColumns(
        {"code_6": F.lit(None).cast("string"), "desc_6": F.lit(None).cast("string")}
    )
    eights = direct.unionByName(fallback)

    def rows(frame, n, levels):
        return frame.select(
            F.col(f"code_{n}").alias("code"),
            F.concat_ws("; ", *[f"desc_{m}" for m in levels]).alias("description")
            if len(levels) > 1
            else F.col(f"desc_{n}").alias("description"),
            F.lit(f"hs_{n}").alias("type"),
            parent_of(frame, n).alias("parent_code"),
        ).distinct()

    def parent_of(frame, n):
        if n == 2:
            return F.lit(None).cast("string")
        if n == 8:
            return F.coalesce("code_6", "code_4")
        return F.substring(f"code_{n}", 1, n - 2)

    tree = reduce(
        lambda a, b: a.unionByName(b),
        [rows(two, 2, [2]), rows(fours, 4, [2, 4]), rows(sixes, 6, [2, 4, 6]),
         rows(eights, 8, [2, 4, 6, 8])],
    )
    return tree.withColumns(
        {"country_code": F.lit(country_code), "country_name": F.lit(country_name)}
    ).select(
        hash_key("hscode").alias("dv_hashkey_hscode"),
        *audit_columns(record_source, load_ts, source_version),
        "code", "description", "type", "country_code", "country_name", "parent_code",
    )
