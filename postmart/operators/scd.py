"""Slowly changing dimensions (H11) and facts that take the version of their time (H9).

Type 2: one full outer join of the current members with the incoming snapshot on the
natural key; each joined row emits one or two version rows (an array exploded in the
same stage), so there is no second pass and no self-join. History rows (not current)
pass through untouched. Type 1 overwrites the tracked attributes in place.

``history`` makes versions of any number of snapshots at once, late and backdated ones included:
observations are sorted by member and time, and only those that differ from the one before
them start a version. ``as_of`` joins a fact to the version that is valid at its time. Both
work in bins of time, so a member with a third of all rows is spread over its bins.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_attributes(cols: Sequence[str], left: str, right: str) -> Column:
    """No tracked attribute differs; NULL equals NULL."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
    return out


def scd_dimension(current: DataFrame, incoming: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
                  as_of: _dt.date | str, kind: int = 2, close_missing: bool = False) -> DataFrame:
    """Merge a new snapshot into a dimension.

    ``current``: natural_key + tracked + valid_from, valid_to, is_current.
    ``incoming``: natural_key + tracked. Result has the same columns plus ``change``:
    'unchanged', 'closed' (old version of a changed member, or a vanished one with
    ``close_missing``), 'opened' (new version of a changed member), 'new', 'history'.
    """
    nk, tr = list(natural_key), list(tracked)
    as_of_col = F.lit(as_of).cast("date")
    hist = current.where(~F.col("is_current")).withColumn("change", F.lit("history"))
    cur = current.where(F.col("is_current")).select(
        *nk, *[F.col(c).alias(f"c_{c}") for c in tr], F.col("valid_from").alias("c_from"),
        F.col("valid_to").alias("c_to"))
    new = incoming.select(*nk, *[F.col(c).alias(f"n_{c}") for c in tr], F.lit(True).alias("_in"))
    j = cur.join(new, nk, "full_outer")
    in_cur = F.col("c_from").isNotNull()
    in_new = F.col("_in").isNotNull()
    same = same_attributes(tr, "c_", "n_")

    def version(prefix, vfrom, vto, is_current, change):
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in tr], vfrom.alias("valid_from"),
                        vto.alias("valid_to"), F.lit(is_current).alias("is_current"), F.lit(change).alias("change"))

    null_date = F.lit(None).cast("date")
    if kind == 1:
        versions = F.when(in_cur & in_new, F.array(version("n_", F.col("c_from"), F.col("c_to"), True, "updated")))
    elif kind == 2:
        versions = F.when(in_cur & in_new & same,
                          F.array(version("c_", F.col("c_from"), F.col("c_to"), True, "unchanged"))) \
            .when(in_cur & in_new,
                  F.array(version("c_", F.col("c_from"), as_of_col, False, "closed"),
                          version("n_", as_of_col, null_date, True, "opened")))
    else:
        raise ValueError("kind must be 1 or 2")
    keep_cur = version("c_", F.col("c_from"), as_of_col, False, "closed") if close_missing else \
        version("c_", F.col("c_from"), F.col("c_to"), True, "unchanged")
    versions = versions.when(in_cur, F.array(keep_cur)) \
        .otherwise(F.array(version("n_", as_of_col, null_date, True, "new")))
    merged = j.select(*nk, F.explode(versions).alias("v")).select(*nk, "v.*")
    return merged.unionByName(hist.select(*merged.columns))


#: Days in a bin of time: rows of one member and bin are sorted by one task.
BIN_DAYS = 32


def _bin(at: Column | str, days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(at)) / days)


def history(observed: DataFrame, natural_key: Sequence[str], tracked: Sequence[str], at: str,
            arrival: str | None = None, bin_days: int = BIN_DAYS) -> DataFrame:
    """Type 2 versions of every member from all its observations, by gaps and islands.

    ``observed``: natural_key + tracked + ``at`` (date or timestamp), in any order and from any
    number of snapshots. Of several observations of a member at one time the one with the largest
    ``arrival`` counts, equal ones (or without ``arrival``) the one with the largest tracked values.
    Rows without a time or with a NULL in the natural key are left out. Returns natural_key +
    tracked + valid_from, valid_to (the next version's start, NULL for the current), is_current.

    First each (member, bin) drops observations that repeat the one before; what is left, a row
    for each bin and each change, is compared across bins.
    """
    nk, tr = list(natural_key), list(tracked)
    whole = F.col(at).isNotNull()
    for c in nk:
        whole = whole & F.col(c).isNotNull()
    state = F.struct(*tr)
    rank = F.struct(*([F.col(arrival)] if arrival else []), state)
    once = (observed.where(whole).groupBy(*nk, F.col(at).alias("valid_from"))
            .agg(F.max_by(state, rank).alias("state"))
            .select(*nk, "valid_from", "state", _bin("valid_from", bin_days).alias("_bin")))

    def changes(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("valid_from")
        before = F.lag("state").over(w)
        first = F.row_number().over(w) == 1
        return rows.withColumn("_starts", first | ~before.eqNullSafe(F.col("state"))).where("_starts").drop("_starts")

    starts = changes(changes(once, [*nk, "_bin"]), nk)
    following = F.lead("valid_from").over(Window.partitionBy(*nk).orderBy("valid_from"))
    return starts.withColumn("valid_to", following).select(
        *nk, *(F.col(f"state.{c}").alias(c) for c in tr), "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def as_of(fact: DataFrame, versions: DataFrame, on: dict[str, str], at: str, keep: Sequence[str],
          valid_from: str = "valid_from", bin_days: int = BIN_DAYS) -> DataFrame:
    """Every fact row with the columns ``keep`` of the version of its member that is valid at ``at``.

    ``on`` maps fact columns to version columns. A version holds from ``valid_from`` until the
    next of its member starts; a fact row before the first version, without a time or with a
    NULL key gets NULLs. Versions of a member at one time: the one with the largest ``keep`` values.

    For each (member, bin) that the fact has, the candidates are the versions that start in the
    bin and the last one before it; that one is found on distinct (member, bin) pairs, not on
    fact rows. The fact then joins on member and bin, an equi-join that adaptive execution splits
    where a member is hot; no fact row is sorted into a window.
    """
    keys = list(on)
    v = (versions.groupBy(*[F.col(c).alias(f"_v_{k}") for k, c in on.items()], F.col(valid_from).cast("timestamp_ntz").alias("_from"))
         .agg(F.max(F.struct(*keep)).alias("_version")).where("_from IS NOT NULL")
         .withColumn("_v_bin", _bin("_from", bin_days)))
    members = [f"_v_{k}" for k in keys]
    timed = fact.withColumn("_at", F.col(at).cast("timestamp_ntz")).withColumn("_bin", _bin("_at", bin_days))
    asked = timed.where("_bin IS NOT NULL").select(*[F.col(k).alias(f"_v_{k}") for k in keys], F.col("_bin").alias("_v_bin")).dropna().distinct()
    # Pairs stand in front of the versions of their bin, so the last version before a pair is carried into the bin.
    both = v.select(*members, "_v_bin", F.lit(1).alias("_kind"), "_from", "_version").unionByName(
        asked.select(*members, "_v_bin", F.lit(0).alias("_kind")), allowMissingColumns=True)
    w = Window.partitionBy(*members).orderBy("_v_bin", "_kind", "_from").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_last", F.last(F.when(F.col("_kind") == 1, F.struct("_from", "_version")), ignorenulls=True).over(w)).where(
        "_kind = 0 AND _last IS NOT NULL").select(*members, "_v_bin", "_last._from", "_last._version")
    candidates = carried.unionByName(v.join(asked, [*members, "_v_bin"], "left_semi").select(*members, "_v_bin", "_from", "_version"))
    until = F.lead("_from").over(Window.partitionBy(*members, "_v_bin").orderBy("_from"))
    candidates = candidates.withColumn("_until", until)
    match = F.col("_bin") == F.col("_v_bin")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_v_{k}"))
    match = match & (F.col("_at") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("_at") < F.col("_until")))
    return timed.join(candidates, match, "left").select(*fact.columns, *(F.col(f"_version.{c}").alias(c) for c in keep))
