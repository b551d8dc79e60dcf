"""Reconciling a new dump with the store, incremental harvests, and bulk upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_write(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last by ``order``."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def reconcile(store: DataFrame, dump: DataFrame, now: Column) -> DataFrame:
    """(doc_id, action, resurrected): repaired, updated, deleted or new.

    store: doc_id, scraped, deleted, last_seen, n_attachments, failed_download (whether any view failed to download).
    dump: doc_id, status, n_attachments, one row an id. Only undeleted rows last seen before ``now`` are compared; an id that the dump
    has and the compared rows have not is new unless withdrawn, and resurrected where the store had it as deleted.
    """
    s = store.select("doc_id", "scraped", "last_seen", F.coalesce("deleted", F.lit(False)).alias("deleted"), F.col("n_attachments").alias("had"), F.coalesce("failed_download", F.lit(False)).alias("failed_download"), F.lit(True).alias("_s"))
    d = dump.select("doc_id", "status", F.coalesce("n_attachments", F.lit(0)).alias("has"), F.lit(True).alias("_d"))
    compared = F.col("_s") & ~F.col("deleted") & (F.col("last_seen") < now)
    broken = (F.col("scraped") == "failed") | F.col("failed_download") | ((F.col("scraped") == "yes") & (F.coalesce("had", F.lit(0)) != F.col("has")))
    fresh = F.col("_d") & (F.coalesce("status", F.lit("")) != "Withdrawn") & (F.col("_s").isNull() | F.col("deleted"))
    action = F.when(compared & F.col("_d").isNull(), "deleted").when(compared & broken, "repaired").when(compared, "updated").when(fresh, "new")
    out = s.join(d, "doc_id", "full_outer").withColumn("action", action)
    return out.where(F.col("action").isNotNull()).select("doc_id", "action", F.coalesce(F.col("deleted") & (F.col("action") == "new"), F.lit(False)).alias("resurrected"))


def apply_actions(store: DataFrame, actions: DataFrame, now: Column) -> DataFrame:
    """The store after its actions: repaired rows are to be scraped again and leave all indexes, seen rows get the time, missing
    ones are deleted, new ones come in."""
    joined = store.join(actions.select("doc_id", "action"), "doc_id", "full_outer")
    act = F.col("action")
    seen = act.isin("repaired", "updated", "new")
    return joined.select(
        "doc_id",
        F.when(act.isin("repaired", "new"), "no").otherwise(F.col("scraped")).alias("scraped"),
        F.when(act == "deleted", True).when(act == "new", False).otherwise(F.coalesce("deleted", F.lit(False))).alias("deleted"),
        F.when(seen, now).otherwise(F.col("last_seen")).alias("last_seen"),
        *(F.when(act.isin("repaired", "new"), F.lit(False)).otherwise(F.col(c)).alias(c) for c in ("in_aggregates", "in_search_index", "in_cluster_db") if c in store.columns),
    )


def incremental_new(store: DataFrame, feed: DataFrame, high_water: Column, now: Column) -> DataFrame:
    """Feed rows in [high water less a day, now and a day] that the undeleted store has not and that are not withdrawn."""
    low = F.date_sub(F.least(high_water, now), 1)
    inside = feed.where(F.col("date_posted").between(low, F.date_add(now, 1)) & (F.coalesce("status", F.lit("")) != "Withdrawn"))
    return inside.join(store.where(~F.coalesce("deleted", F.lit(False))).select("doc_id"), "doc_id", "left_anti")


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str, update: tuple[str, ...] = ()) -> DataFrame:
    """The target with rows whose key it has not; fields to update are overwritten, arrays only where their length differs, and
    ``scraped`` not where it is "yes" already."""
    fresh = rows.join(target.select(key), key, "left_anti")
    joined = target.alias("t").join(rows.select(key, *update, F.lit(True).alias("_got")).alias("n"), key, "left")

    def value(c: str) -> Column:
        old, new = F.col(f"t.{c}"), F.col(f"n.{c}")
        if target.schema[c].dataType.typeName() == "array":
            take = F.coalesce(F.size(old) != F.size(new), F.lit(True))
        elif c == "scraped":
            take = F.coalesce(old != "yes", F.lit(True))
        else:
            take = F.lit(True)
        return F.when(F.col("n._got") & take, new).otherwise(old)

    kept = joined.select(key, *((value(c) if c in update else F.col(f"t.{c}")).alias(c) for c in target.columns if c != key))
    return kept.unionByName(fresh.select(*target.columns))


def merge_records(records: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: of each field the last that is there, in the given order."""
    fields = [c for c in records.columns if c not in (key, order)]
    return records.groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields))


def stub_missing(docs: DataFrame, dockets: DataFrame) -> DataFrame:
    """Dockets that documents name and that are not there, as rows with an id alone."""
    return docs.where(F.col("docket_id").isNotNull()).select("docket_id").distinct().join(dockets.select("docket_id"), "docket_id", "left_anti")


def upsert_agencies(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Agencies with name and participating flag set from the incoming rows; inserted where absent, marked as such."""
    joined = current.alias("c").join(incoming.alias("i"), "id", "full_outer")
    return joined.select("id", F.coalesce("i.name", "c.name").alias("name"), F.coalesce("i.participating", "c.participating").alias("participating"), F.col("c.name").isNull().alias("inserted"))


def apply_scrape_results(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Documents after scraping: results (doc_id asked for, found_id, title, error). A fresh record replaces the old one but for
    last_seen and created; another id means renamed; an error means failed; without a result nothing changes."""
    joined = docs.alias("d").join(results.select("doc_id", "found_id", F.col("title").alias("_title"), "error", F.lit(True).alias("_got")), "doc_id", "left")
    failed, renamed = F.col("error").isNotNull(), F.col("_got") & F.col("found_id").isNotNull() & (F.col("found_id") != F.col("doc_id"))
    fresh = F.col("_got") & ~F.coalesce(failed, F.lit(False)) & (F.col("found_id") == F.col("doc_id"))
    return joined.select(
        "doc_id",
        F.when(fresh, F.col("_title")).otherwise(F.col("d.title")).alias("title"),
        F.when(failed, "failed").when(fresh | renamed, "yes").otherwise(F.col("d.scraped")).alias("scraped"),
        F.coalesce(renamed, F.lit(False)).alias("renamed"),
        F.when(renamed, F.col("found_id")).alias("renamed_to"),
        "d.last_seen",
        "d.created",
    )


def copy_subset(docs: DataFrame, files: DataFrame, dockets: DataFrame, keep: Column, there: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents that match, fresh for all later stages; the files that their views name (column object_ids), less those that are at the target; and
    their dockets. The source defaults to regulations.gov."""
    chosen = docs.where(keep).withColumns({c: F.lit(False) for c in ("in_aggregates", "in_cluster_db", "in_search_index")}).withColumn("source", F.coalesce("source", F.lit("regulations.gov")))
    named = chosen.select(F.explode("object_ids").alias("object_id")).distinct()
    wanted = files.join(named, "object_id", "left_semi")
    wanted = wanted.join(there.select("object_id"), "object_id", "left_anti") if there is not None else wanted
    return chosen, wanted, dockets.join(chosen.select("docket_id").distinct(), "docket_id", "left_semi")
