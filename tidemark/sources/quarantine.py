"""Records set aside: kept in a table of their own until a later run can store them.

A record that cannot be stored would be lost once its repository's high-water mark has passed
it. So it is held with the reason and its row as JSON, and a run lets the records that are held
pass whatever the mark. Once its record is stored, a held one is released; one that stays bad
is kept with its latest reason. A run that changes nothing writes nothing.

A record is known by the first of several identities that is whole (``repository and number``,
``repository and id``), or by a hash of its row where none is.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import run_time, to_time
from tidemark.operators.sizing import any_null, fits_broadcast
from tidemark.sources import catalog
from tidemark.sources.staging import staged

KEY, REASON, ROW, SINCE = "reject_key", "reject_reason", "row", "held_since"
#: Columns of one identity.
Identity = tuple[str, ...]


def identity_key(identity: Identity) -> Column:
    """The record's key under one identity; NULL unless all its columns are there."""
    kind = F.lit("+".join(identity))
    whole = F.to_json(F.array(kind, *[F.col(c).cast("string") for c in identity]))
    return F.when(~any_null(identity), whole)


def reject_key(identities: Sequence[Identity], row: Column) -> Column:
    return F.coalesce(*map(identity_key, identities), F.sha2(row, 256))


def held_rows(rejects: DataFrame, identities: Sequence[Identity], columns: Sequence[str], at: datetime | None = None) -> DataFrame:
    """Rejects as they are held: key, identifying columns, reason, since when, and ``columns`` as JSON.

    Repeated landings of one record are held once.
    """
    ids = list(dict.fromkeys(c for identity in identities for c in identity))
    keyed = rejects.withColumn(ROW, F.to_json(F.struct(*columns))).withColumn(KEY, reject_key(identities, F.col(ROW)))
    one = keyed.groupBy(KEY).agg(F.min(F.struct(REASON, ROW, *ids)).alias("r"))
    return one.select(KEY, *[F.col(f"r.{c}") for c in (*ids, REASON, ROW)], to_time(run_time(at)).alias(SINCE))


def read_held(spark: SparkSession, name: str) -> DataFrame | None:
    return catalog.read(spark, name)


def is_held(rows: DataFrame, held: DataFrame | None, identities: Sequence[Identity], flag: str) -> DataFrame:
    """Adds ``flag``: whether the row's record is held, under whichever identity.

    Held keys are broadcast if they are measured to fit; the joins are by whole keys, so that
    rows without identity stay where they are.
    """
    if held is None:
        return rows.withColumn(flag, F.lit(False))
    keys = held.select(KEY).distinct()
    keys = F.broadcast(keys) if fits_broadcast(keys) else keys
    out, found = rows, []
    for k, identity in enumerate(identities):
        own, met = f"_key_{k}", f"_held_{k}"
        out = out.withColumn(own, identity_key(identity))
        out = out.join(keys.select(F.col(KEY).alias(own), F.lit(True).alias(met)), own, "left").drop(own)
        found.append(F.coalesce(met, F.lit(False)))
    return out.withColumn(flag, reduce(lambda a, b: a | b, found)).drop(*[f"_held_{k}" for k in range(len(identities))])


def waiting_rows(held: DataFrame, news: DataFrame, landed: DataFrame, on: Identity, ddl: str) -> DataFrame:
    """Rows of held records that were not landed again, but of which ``news`` says that something was.

    ``news`` and ``landed`` carry the columns ``on``; the row's own columns come from its JSON. Both
    are cut down to held records first, which are few, before anything of them is shuffled.
    """
    keys = held.select(*on).distinct()
    keys = F.broadcast(keys) if fits_broadcast(keys) else keys
    of_held = lambda df: df.select(*on).join(keys, list(on), "left_semi").distinct()
    absent = held.join(of_held(news), list(on), "left_semi").join(of_held(landed), list(on), "left_anti")
    return absent.select(F.from_json(ROW, ddl).alias("r")).select("r.*")


def settle(spark: SparkSession, name: str, rejected: DataFrame, stored: DataFrame, identities: Sequence[Identity]) -> dict[str, int]:
    """Bring the table up to date after a run; how many are new, changed, released and held.

    ``rejected`` are this run's ``held_rows``, ``stored`` the records that it could store. The table
    is read once for what concerns it; rows are written only for a difference: new ones are
    appended, and only a change or a release makes a new version.
    """
    held = read_held(spark, name)
    with staged(rejected, "rejected") as rejected:
        if held is None:
            new = rejected.count()
            if new:
                catalog.create_as(rejected, name)
            return {"new": new, "changed": 0, "released": 0, "held": new}
        before = held.select(KEY, F.col(REASON).alias("old_reason"), F.col(ROW).alias("old_row"), F.col(SINCE).alias("old_since"))
        compared = rejected.join(before, KEY, "left")
        differs = ~(F.col(REASON).eqNullSafe(F.col("old_reason")) & F.col(ROW).eqNullSafe(F.col("old_row")))
        new, changed = F.col("old_since").isNull(), F.col("old_since").isNotNull() & differs
        # What is stored now and not rejected at the same time.
        gone = is_held(stored, held, identities, "_held").filter("_held")
        keys = reduce(DataFrame.unionByName, [gone.select(identity_key(i).alias(KEY)) for i in identities])
        gone = held.select(KEY).join(keys, KEY, "left_semi").join(rejected, KEY, "left_anti")
        kind = F.when(new, "new").when(changed, "changed").otherwise("same")
        first = F.coalesce("old_since", SINCE).alias(SINCE)
        rows = compared.select(*[c for c in held.columns if c != SINCE], first, kind.alias("_kind"))
        gone = held.join(gone, KEY, "left_semi").withColumn("_kind", F.lit("released"))
        with staged(rows.filter("_kind <> 'same'").unionByName(gone), "settled") as moves:
            count = {r["_kind"]: r["count"] for r in moves.groupBy("_kind").count().collect()}
            put = moves.filter("_kind <> 'released'").drop("_kind")
            if count.get("changed") or count.get("released"):
                catalog.publish(held.join(moves.select(KEY), KEY, "left_anti").unionByName(put), name)
            elif count.get("new"):
                catalog.append(put, name)
    out = {k: count.get(k, 0) for k in ("new", "changed", "released")}
    return {**out, "held": catalog.read(spark, name).count()}
