"""Merging of newer rows into a table by key."""

from pyspark.sql import functions as F


def newest_per_key(rows, keys, version=None):
    """One row per key: that of the highest version, and of equal versions the one whose values are
    the largest, in the order of the columns. Reduced in the tasks that read the rows."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    order = F.struct(*([version] if version else []), *others)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_best"))
    return best.select(*keys, "_best.*").select(*rows.columns)


def upsert(current, incoming, keys, version=None):
    """Rows of `incoming` replace rows of `current` with the same key; others are kept.

    The kept rows come from an anti join on the keys, so the larger, older side is never sorted
    for a ranking. Several incoming rows of one key are reduced to one; `version` names the column
    that tells the newest.
    """
    incoming = newest_per_key(incoming, keys, version)
    kept = current.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming)
