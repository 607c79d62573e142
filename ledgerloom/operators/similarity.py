"""Blocked edit-distance join (E6, E7, J9) without comparing whole blocks.

Two names match when they share jurisdiction and first letters, differ little
in length and word count, and reach a similarity in percent. Comparing every
pair of a block is quadratic in its size, so candidates come from equi-joins on
signatures that two strings within the allowed number of edits must share:

* few edits: equal after dropping at most that many characters each. Each name
  emits itself and what is left of it after one deletion, or two where the
  name is short. Such a signature has few owners, whatever the names look like.
* more edits, say t: an edit touches at most q of a name's q-grams, so of the
  q t + 1 grams that come first in any one order one is left unedited, at most t
  places away in the other name. The order is from rare to common among the trusted
  names of the block. So names that share a tail, or words, meet by what
  is their own (prefix filtering on positional grams; Ed-Join, Xiao et al., VLDB 2008).
* more edits than a short name has grams for: of t + 1 consecutive pieces of one
  name, one survives unedited in the other. The piece numbered i (from 0) need only
  be sought where at most i edits lie before it and t - i after it (partition scheme
  and multi-match-aware selection of Pass-Join, Li et al., VLDB 2011).

All are exact: no match is lost, and the bounded distance settles the rest.
Names are made distinct first, so copies of a name cost nothing. A candidate is measured once for
each signature it meets by, and only matches are shuffled.
"""

from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.sources.staging import staged

SHORT_REST = 16
#: Letters of the shortest gram; names with too few of these are cut into pieces.
LEAST_GRAM = 2


def blocking_features(df, base="pure_name", first_chars=6):
    """First letters, number of spaces and length of a name."""
    return df.withColumns(
        {
            f"{base}_first_char": F.lower(F.substring(base, 1, first_chars)),
            f"{base}_space_count": F.size(F.split(base, " ")) - 1,
            f"{base}_length": F.length(base),
        }
    )


def _edits(length, threshold):
    """Largest distance at which a pair whose longer name has this length matches."""
    return f"cast(floor(({length}) * {100 - threshold} / 100.0 + 1e-6) as int)"


def _deletions(texts):
    """All texts of an array with one character less."""
    return f"""array_distinct(flatten(transform({texts}, v ->
        transform(filter(sequence(0, length(v)), i -> i > 0),
            i -> concat(substring(v, 1, i - 1), substring(v, i + 1))))))"""


def _by_deletion(length, threshold, stripped):
    """Whether a pair whose longer name has this length is found by deletions."""
    edits = _edits(length, threshold)
    return f"({edits} < 2 or ({edits} = 2 and ({length}) - {stripped} <= {SHORT_REST}))"


def _dropped(df, threshold, length_diff, stripped):
    """Add ``sig``: a row per text that is left of ``rest`` after the deletions that count for a name.

    ``rest`` is the part of the name in which a pair can differ, ``len`` the
    length of the whole name, of which ``stripped`` letters are not in the
    rest. The longer length of a pair decides which signatures count for it,
    so a name emits those of every length its partners may bring it to.
    """
    found = lambda n: _by_deletion(n, threshold, stripped)
    longest = f"transform(sequence(0, {length_diff}), k -> len + k)"
    depth = f"array_max(transform(filter({longest}, n -> {found('n')}), n -> {_edits('n', threshold)}))"
    one = _deletions("array(rest)")
    drops = f"""
        case {depth}
             when 0 then array(rest)
             when 1 then concat(array(rest), {one})
             when 2 then concat(array(rest), {one}, {_deletions(one)})
             else array() end"""
    return df.withColumn("sig", F.explode(F.expr(f"array_distinct(transform({drops}, v -> xxhash64(v)))")))


def _cases(df, threshold, length_diff, stripped, indexed):
    """A row per number of edits ``t`` and length ``m`` of the trusted name under which a name is cut into pieces.

    ``q`` is the length of the grams by which such a pair is found, 0 where it is by pieces.
    """
    found = lambda n: _by_deletion(n, threshold, stripped)
    if indexed:
        longest = f"transform(sequence(0, {length_diff}), k -> len + k)"
        cases = f"""transform(
            array_distinct(transform(filter({longest}, n -> not {found('n')}), n -> {_edits('n', threshold)})),
            t -> named_struct('m', len, 't', t))"""
    else:
        cases = f"""transform(
            filter(sequence(len - {length_diff}, len + {length_diff}),
                   m -> m >= 0 and length(rest) + m - len >= 0 and not {found('greatest(len, m)')}),
            m -> named_struct('m', m, 't', {_edits('greatest(len, m)', threshold)}))"""
    own = _trusted_rest(indexed)
    # long grams are rare; at half the length of a piece half of the grams are first ones, the common half is not
    length = F.expr(f"if({own} >= {LEAST_GRAM} * (t + 1), greatest({LEAST_GRAM}, cast(floor({own} / (2 * (t + 1))) as int)), 0)")
    cased = df.withColumn("case", F.explode(F.expr(cases))).select(*df.columns, "case.m", "case.t")
    return cased.withColumn("q", length)


def _trusted_rest(indexed):
    """The length of the trusted name's rest, as either side of a pair knows it."""
    return "length(rest)" if indexed else "(length(rest) + m - len)"


NAMED = ["jurisdiction", "block", "name_text"]
SIGNED = ["jurisdiction", "block", "sig"]


def _grams(cases):
    """The grams of names, with their places: one row each, by name and q."""
    places = "filter(sequence(1, length(rest)), p -> p <= length(rest) - q + 1)"
    own = cases.where("q > 0 and length(rest) > 0").select(*NAMED, "rest", "q").distinct()
    return own.withColumn("at", F.explode(F.expr(places))).select(
        *NAMED, "q", "at", F.expr("substring(rest, at, q)").alias("gram")
    )


def _first_grams(cases, grams, uses):
    """Add ``sig`` and ``at``: a row per gram of a name that comes first in the order from rare to common."""
    counted = grams.join(uses, ["jurisdiction", "block", "q", "gram"], "left")
    ranked = counted.groupBy(*NAMED, "q").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("uses", F.lit(0).cast("long")).alias("uses"), "gram", "at"))).alias("grams")
    )
    first = cases.join(ranked, [*NAMED, "q"]).withColumn("g", F.explode(F.expr("slice(grams, 1, q * t + 1)")))
    return first.withColumns({"sig": F.expr("xxhash64(t, m, q, g.gram)"), "at": F.col("g.at")}).drop("grams", "g")


def _pieces(cases, indexed):
    """Add ``sig``: a row per piece of ``rest`` (trusted), or per place where a trusted one may stand."""
    own = _trusted_rest(indexed)
    size = f"cast(floor({own} / (t + 1)) as int)"
    plain = f"(t + 1 - {own} % (t + 1))"
    start = f"(i * {size} + greatest(i - {plain}, 0))"
    width = f"({size} + if(i >= {plain}, 1, 0))"
    if indexed:
        places = f"transform(sequence(0, t), i -> named_struct('i', i, 'at', {start}, 'width', {width}))"
    else:
        places = f"""flatten(transform(sequence(0, t), i -> transform(
            filter(sequence(-i, i), s -> abs(s - (len - m)) <= t - i and {start} + s >= 0
                                         and {start} + s + {width} <= length(rest)),
            s -> named_struct('i', i, 'at', {start} + s, 'width', {width}))))"""
    cut = cases.where("q = 0").withColumn("piece", F.explode(F.expr(places)))
    return cut.withColumn(
        "sig", F.expr("xxhash64(t, m, piece.i, substring(rest, piece.at + 1, piece.width))")
    ).drop("piece")


def _candidates(probing, trusted, threshold, length_diff, stripped):
    """Pairs of distinct names that share a signature: of deletions, of rare grams, or of pieces."""
    limits = threshold, length_diff, stripped
    pairs = _meet(_dropped(probing, *limits), _dropped(trusted, *limits))
    sought, owned = _cases(probing, *limits, indexed=False), _cases(trusted, *limits, indexed=True)
    grams = _grams(owned)
    # written first: a join that reads an aggregate of its own key is not split where a gram is in very many names
    uses = staged(grams.groupBy("jurisdiction", "block", "q", "gram").agg(F.count(F.lit(1)).alias("uses")), "grams")
    by_gram = _meet(_first_grams(sought, _grams(sought), uses), _first_grams(owned, grams, uses), at=True)
    return pairs.unionByName(by_gram).unionByName(_meet(_pieces(sought, indexed=False), _pieces(owned, indexed=True)))


def _meet(sought, owned, at=False):
    """Pairs by equal signatures, with ``at`` only where the places of the grams are within the edits."""
    features = ["name_text", "len", "spaces"]
    places = ["at"] if at else []
    both = sought.select(*SIGNED, *features, *places, *(["t"] if at else [])).join(
        owned.select(*SIGNED, *[F.col(c).alias(f"m_{c}") for c in [*features, *places]]), SIGNED
    )
    near = both.where("abs(at - m_at) <= t") if at else both
    return near.drop("sig", "t", "at", "m_at")


def _distinct_names(df, base, first_chars, case_folded):
    """Distinct (jurisdiction, name) with the features the join needs."""
    rest = F.expr(f"substring(name_text, {int(first_chars) + 1})") if case_folded else F.col("name_text")
    return (
        df.where(F.col(base).isNotNull() & F.col("jurisdiction").isNotNull())
        .select("jurisdiction", F.col(base).alias("name_text"))
        .distinct()
        .select(
            "jurisdiction",
            "name_text",
            F.lower(F.substring("name_text", 1, first_chars)).alias("block"),
            F.length("name_text").alias("len"),
            (F.size(F.split("name_text", " ")) - 1).alias("spaces"),
            rest.alias("rest"),
        )
    )


def similar_names(
    to_verify, trusted, base="pure_name", threshold=95, first_chars=6, length_diff=3, space_diff=3
):
    """Distinct pairs of names that match, with distance and similarity."""
    case_folded = base in ("pure_name", "regexed_name")
    stripped = first_chars if case_folded else 0
    t, m = (_distinct_names(df, base, first_chars, case_folded) for df in (to_verify, trusted))
    longest = "greatest(len, m_len)"
    return (
        _candidates(t, m, threshold, length_diff, stripped)
        .where(
            (F.abs(F.col("len") - F.col("m_len")) <= length_diff)
            & (F.abs(F.col("spaces") - F.col("m_spaces")) <= space_diff)
        )
        # a generated column: a filter on a plain one would be moved into the joins, each of its parts measuring anew
        .withColumn("distance", F.explode(F.array(F.expr(f"levenshtein(name_text, m_name_text, {_edits(longest, threshold)})"))))
        .where("distance >= 0")
        .distinct()
        .withColumn(
            "similarity_percentage",
            F.when(F.expr(longest) > 0, (1 - F.col("distance") / F.expr(longest)) * 100),
        )
        .where(F.col("similarity_percentage") >= threshold)
        .select(
            "jurisdiction", "name_text", F.col("m_name_text").alias("verified_text"),
            "distance", F.expr(longest).alias("max_length"), "similarity_percentage",
        )
    )


def matched_names(to_verify, trusted, base="pure_name", **limits):
    """All pairs of distinct names that match, with how many rows carry either name.

    Rows join to a pair by jurisdiction and name; their product is never built.
    """
    def rows_by(df, text, count):
        return df.groupBy("jurisdiction", F.col(base).alias(text)).agg(F.count("*").alias(count))

    return (
        similar_names(to_verify, trusted, base, **limits)
        .join(rows_by(to_verify, "name_text", "n_rows"), ["jurisdiction", "name_text"])
        .join(rows_by(trusted, "verified_text", "n_verified"), ["jurisdiction", "verified_text"])
    )


def levenshtein_match(
    to_verify,
    trusted,
    base="pure_name",
    method="levenshtein",
    threshold=95,
    first_chars=6,
    length_diff=3,
    space_diff=3,
):
    """Rows to verify with their best trusted match.

    The highest similarity wins, then the verified name, then the verified hash.
    All matches are pairs of names, see ``matched_names``: rows of equal names
    are not multiplied.
    """
    pairs = similar_names(
        to_verify, trusted, base, threshold, first_chars, length_diff, space_diff
    )
    masters = trusted.select(
        "jurisdiction",
        F.col(base).alias("verified_text"),
        F.col("dv_hashkey_company").alias("verified_dv_hashkey_company"),
        F.col("registration_number").alias("verified_registration_number"),
        F.col("name").alias("verified_name"),
    )
    pairs = first_per_key(
        pairs,
        ["jurisdiction", "name_text"],
        [F.col("similarity_percentage").desc(), F.col("verified_text").asc()],
        complete=False,
    )
    masters = first_per_key(
        masters, ["jurisdiction", "verified_text"], [F.col("verified_dv_hashkey_company").asc()]
    )
    matched = pairs.join(masters, ["jurisdiction", "verified_text"])
    subject = to_verify.select(
        "jurisdiction", "dv_hashkey_company", "registration_number", "name",
        F.col(base).alias("name_text"), "dv_recsrc", "dv_source_version",
    )
    return subject.join(matched, ["jurisdiction", "name_text"]).select(
        "jurisdiction", "dv_hashkey_company", "registration_number", "name",
        F.col("name_text").alias(base), "dv_recsrc", "dv_source_version",
        "verified_dv_hashkey_company", F.col("verified_text").alias(f"verified_{base}"),
        "verified_registration_number", "verified_name", "max_length", "distance",
        "similarity_percentage", F.lit(method).alias("verify_method"),
    )
