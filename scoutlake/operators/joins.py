"""Lookups, matching joins and nested enrichment.

No join carries a broadcast hint: small sides are broadcast by Spark when their
measured size is under the threshold, larger ones use a shuffle join whose
skewed partitions are split at run time.
"""

from pyspark.sql import functions as F

from .shape import dedup, suffix


def left_join(df, other, keys):
    return df.join(other, keys, "left")


def inner_join(df, other, keys):
    return df.join(other, keys, "inner")


def map_column(df, col, lookup, key="key", value="value", order=None, out=None):
    """Replace a column by its value in a lookup; unknown keys give null.

    Of several values for a key the last by the column ``order`` wins, without it the largest value.
    """
    out = out or col
    order = F.col(order) if order else F.col(value)
    table = (lookup.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"))
             .agg(F.max_by(F.col(value), order).alias("_v")))
    joined = df.join(table, df[col] == table["_k"], "left")
    cols = [F.col("_v").alias(c) if c == out else df[c] for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("_v").alias(out))
    return joined.select(cols)


def outer_match(a, b, keys, id_a, id_b, suffixes=("SS", "SW"), order=None):
    """Full outer join on the keys, then one row per first-side id.

    Rows without that id are all kept.  The rank is taken only among rows that
    have the id, so the many id-less rows never meet in one window partition.
    """
    left, right = suffix(a, [*keys, id_a], suffixes[0]), suffix(b, [*keys, id_b], suffixes[1])
    joined = left.join(right, keys, "full_outer")
    known = joined.filter(F.col(id_a).isNotNull())
    first = dedup(known, [id_a], order or [F.col(id_b).asc_nulls_last()])
    return first.unionByName(joined.filter(F.col(id_a).isNull()))


def semi(df, ids, key, id_col=None):
    ids = ids.select(F.col(id_col or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(ids, key, "left_semi")


def anti(df, ids, key, id_col=None):
    ids = ids.select(F.col(id_col or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(ids, key, "left_anti")


def embed(df, ref, key, fields, ref_id="ID", out=None):
    """Struct of reference fields next to each row; null struct where nothing matches.

    The raw key stays in the frame, so an unmatched id is not lost.
    """
    out = out or key + "Info"
    nested = ref.select(F.col(ref_id).alias(key), F.struct(*fields).alias(out))
    return df.join(nested, key, "left")


def squad_pairs(members, team_pairs, team="team", group="grp"):
    """Number of player pairs in a common group for each requested pair of squads.

    Counts multiply per group, so no player pair is ever produced.  A player who
    is in both squads is paired with all but himself.
    """
    sizes = members.groupBy(team, group).agg(F.countDistinct("id").alias("n"))
    a = sizes.select(F.col(team).alias("team_a"), F.col(group).alias("g"), F.col("n").alias("na"))
    b = sizes.select(F.col(team).alias("team_b"), F.col(group).alias("g"), F.col("n").alias("nb"))
    pairs = (team_pairs.select("team_a", "team_b").distinct()
             .join(a, "team_a").join(b, ["team_b", "g"])
             .groupBy("team_a", "team_b").agg(F.sum(F.col("na") * F.col("nb")).alias("pairs")))
    ids = members.select("id", F.col(group).alias("g"), F.col(team).alias("t")).distinct()
    shared = (team_pairs.select("team_a", "team_b").distinct()
              .join(ids.withColumnRenamed("t", "team_a"), "team_a")
              .join(ids.withColumnRenamed("t", "team_b"), ["team_b", "id", "g"], "left_semi")
              .groupBy("team_a", "team_b").agg(F.count("*").alias("shared")))
    return (pairs.join(shared, ["team_a", "team_b"], "left")
            .select("team_a", "team_b",
                    (F.col("pairs") - F.coalesce("shared", F.lit(0))).alias("pairs")))
