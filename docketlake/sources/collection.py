"""The stored collection as a catalog table in buckets of the id, in partitions by agency: scans by scope read the agency's files and the columns asked for, and joins by id
do not move the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.operators import normalize


def write_collection(docs: DataFrame, name: str, *, path: str | None = None, buckets: int = 64, key: str = "doc_id", partition: str | None = "agency") -> None:
    """``docs`` as the table ``name``, one file a bucket and partition. The files lie in ``path``, or in the warehouse. Joins of two collections want the same number of
    buckets; others are dealt out to as many as the collection has."""
    keys = [F.col(partition)] if partition else []
    writer = docs.repartition(buckets, F.col(key), *keys).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer = writer.partitionBy(partition) if partition else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)


def scan_docs(spark: SparkSession, name: str, *, agency: str | None = None, docket: str | None = None, source: str | None = None, types: tuple[str, ...] = (), deleted: bool = False, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Documents of a scope (see ``normalize.scope``), as the columns named; a field of a struct is named by its path. Null dockets, sources and types are in no scope that
    names them. What is not named is not read."""
    found = normalize.scope(spark.table(name), agency=agency, docket=docket, source=source, types=types, deleted=deleted)
    return found.select(*(F.col(c).alias(c.replace(".", "_")) for c in columns)) if columns else found
