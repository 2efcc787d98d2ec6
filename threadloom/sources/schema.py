"""Schemas of the stored tables, and how a table is created where it is missing."""

from __future__ import annotations

from pyspark.sql import SparkSession

THREADS_CLEAN = "question_id string, created_on date, asker string, source_url string, raw_hash binary, clean_hash binary, content_clean string, content_for_llm string, processed_utc timestamp"
THREADS = (
    "thread_id string, source string, source_url string, created_on date, ingested_at timestamp, language string, product string, classification string, resolution_status string, "
    "usefulness decimal(4,3), is_emergent boolean, emergent_signal decimal(4,2), topic_key string, scenario_key string, variant_key string, leaf_key string, signature_text string, resolution_text string, "
    "batch_id string, checked_on date, started_on date, completed_on date, topic_id long, scenario_id long, variant_id long, leaf_id long, mined_on date")
CATALOG = (
    "cluster_id long, cluster_level int, product string, cluster_key string, parent_id long, signature_text string, resolution_text string, member_count int, max_usefulness decimal(4,3), "
    "last_seen date, is_active boolean, created_by string, wiki_path string")
INCIDENTS = "incident_id long, incident_key string, product string, topic_key string, status string, confidence decimal(4,2), first_seen date, last_seen date, thread_count long, resolved_on date, updated_on date, summary string, wiki_path string"
INCIDENT_THREADS = "incident_id long, thread_id string, created_on date, added_on date"
PIPELINE_STATE = "name string, last_on date, last_id string"

TABLES = {"threads_clean": THREADS_CLEAN, "threads": THREADS, "catalog": CATALOG, "incidents": INCIDENTS, "incident_threads": INCIDENT_THREADS, "pipeline_state": PIPELINE_STATE}


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """Creates empty Parquet tables for those that are missing below a folder; says which."""
    jvm, made = spark.sparkContext._jvm, []
    for name, schema in TABLES.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
            made.append(name)
    return made


def swap_in(spark: SparkSession, root: str, name: str, snapshot) -> None:
    """Writes a new snapshot of a table beside the old one and puts it in its place.

    Between two renames there is no table: for small state that one job reads. `sources/tables.py` keeps tables whole."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda x: jvm.org.apache.hadoop.fs.Path(f"{root}/{x}")
    snapshot.write.mode("overwrite").parquet(f"{root}/.{name}.new")
    fs = path(name).getFileSystem(conf)
    fs.delete(path(f".{name}.old"), True)
    if fs.exists(path(name)):
        fs.rename(path(name), path(f".{name}.old"))
    fs.rename(path(f".{name}.new"), path(name))
    fs.delete(path(f".{name}.old"), True)
