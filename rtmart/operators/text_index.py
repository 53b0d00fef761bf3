"""An inverted index for the text match.

Each version adds (term, id, sort key) postings in one folder for each bucket
of terms; a document that is written again takes back the terms that it has
lost, by postings marked as gone. A match reads the folders of its terms'
buckets only and takes the last posting of each (term, id); the first page
is ordered on the postings' own sort key, so only the documents of that page
are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtmart.operators.search import PAGE_SIZE, match_terms, terms_column
from rtmart.operators.upsert import latest_per_key, path_exists, read_versions, write_version

BUCKETS = 64


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(docs: DataFrame, id_col: str, field: str, sort_field: str) -> DataFrame:
    """(term, id, sort_key): one row for each distinct term of a document."""
    return docs.select(F.explode(F.array_distinct(terms_column(field))).alias("term"),
                       F.col(id_col).alias("id"), F.col(sort_field).alias("sort_key")).where("term <> ''")


def _last(spark: SparkSession, path: str, buckets: list[int] | None = None,
          before: int | None = None) -> DataFrame:
    """The last posting of each (term, id) that is not gone."""
    rows = read_versions(spark, path, before=before)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    rows = rows.select("term", "id", "batch_id", "sort_key", "gone")
    return latest_per_key(rows, ["term", "id"], ["batch_id"], deleted_col="gone")


def write_postings(spark: SparkSession, path: str, docs: DataFrame, id_col: str, field: str,
                   sort_field: str, version: int, buckets: int = BUCKETS) -> None:
    """Index new or changed documents, each at most once among ``docs``, as version ``version``."""
    new = postings(docs, id_col, field, sort_field).withColumn("gone", F.lit(False))
    if path_exists(spark, path):
        ids = docs.select(F.col(id_col).alias("id")).distinct()
        old = _last(spark, path, before=version).join(ids, "id", "left_semi")
        lost = old.join(new.select("term", "id"), ["term", "id"], "left_anti")
        new = new.unionByName(lost.select("term", "id", "sort_key", F.lit(True).alias("gone")))
    write_version(new.withColumn("bucket", bucket_of(F.col("term"), buckets)), path, version,
                  partition_by=["bucket"])


def _term_buckets(spark: SparkSession, terms: list[str], buckets: int) -> list[int]:
    hashes = spark.range(1).select(*[bucket_of(F.lit(t), buckets).alias(f"b{i}")
                                     for i, t in enumerate(terms)]).first()
    return sorted(set(hashes))


def matching(spark: SparkSession, path: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, sort_key) of the documents that share a term with ``text``."""
    terms = match_terms(text)
    if not terms:
        return read_versions(spark, path).select("id", "sort_key").limit(0)
    rows = read_versions(spark, path).where(F.col("bucket").isin(_term_buckets(spark, terms, buckets)))
    rows = rows.where(F.col("term").isin(terms)).select("term", "id", "batch_id", "sort_key", "gone")
    # a document's sort key may have changed without its terms: the last one counts
    live = latest_per_key(rows, ["term", "id"], ["batch_id"], deleted_col="gone")
    return live.groupBy("id").agg(F.max(F.struct("batch_id", "sort_key")).alias("l")).select(
        "id", F.col("l.sort_key").alias("sort_key"))


def first_page(spark: SparkSession, path: str, text: str, docs: DataFrame, id_col: str, sort_field: str,
               size: int = PAGE_SIZE, offset: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` on the page that ``search.match_sorted`` gives, found by the index."""
    page = matching(spark, path, text, buckets).orderBy(F.col("sort_key").asc_nulls_first(), "id")
    page = page.offset(offset).limit(size) if offset else page.limit(size)
    found = docs.join(F.broadcast(page.select(F.col("id").alias("_id"))),       # one page of ids
                      F.col(id_col) == F.col("_id"), "left_semi")
    return found.orderBy(F.col(sort_field).asc_nulls_first(), F.col(id_col).asc())
