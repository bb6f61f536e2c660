"""Changes of a table's files that survive being cut off.

A change is prepared first: the new files are complete in a staging folder, partitioned like the
table. Then an intent is recorded below the table, naming the files to move in and the files that go,
and only then is the table touched. Moving a file in, under a name of the intent's own, and
removing one are steps that may be tried again, so ``finish`` can be called any number of times, after
a crash at any step, and ends with each row once. Whoever changes a table's files finishes its open
intents first.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from sightline.sources import folders

#: Spark's readers pass over names that begin with an underscore.
FOLDER = "_intents"


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"describe table extended {table}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def change(
    spark: SparkSession, table: str, staged: str, gone: list[str], source: str | None = None, taken: list[str] | None = None
) -> None:
    """Move the staged files into ``table``, remove its files ``gone``, and the files ``taken`` from ``source``."""
    name = uuid.uuid4().hex
    moves = [f for f, _ in folders.files(spark, staged) if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
    intent = {"name": name, "staged": staged, "moves": moves, "gone": gone, "source": source, "taken": taken or []}
    if source:
        folders.write_text(spark, f"{location(spark, source)}/{FOLDER}/{name}.json", json.dumps({"see": table}))
    folders.write_text(spark, f"{location(spark, table)}/{FOLDER}/{name}.json", json.dumps(intent))
    finish(spark, table)


def finish(spark: SparkSession, table: str) -> list[str]:
    """Complete what was recorded for a table; the names of the intents."""
    at, done = location(spark, table), []
    for file in folders.names(spark, f"{at}/{FOLDER}"):
        if not file.endswith(".json"):
            continue
        path = f"{at}/{FOLDER}/{file}"
        intent = json.loads(folders.read_text(spark, path))
        if "see" in intent:  # the other table has the intent, or it was never recorded
            finish(spark, intent["see"])
        else:
            _apply(spark, table, at, intent)
        done.append(file.removesuffix(".json"))
        folders.remove(spark, path)
    return done


def _apply(spark: SparkSession, table: str, at: str, intent: dict) -> None:
    for i, file in enumerate(intent["moves"]):
        folder, _, last = file.rpartition("/")
        if folders.exists(spark, f"{intent['staged']}/{file}"):
            folders.move(spark, f"{intent['staged']}/{file}", f"{at}/{folder}/{intent['name']}-{i:05d}-{last}")
    for file in [*intent["gone"], *intent["taken"]]:
        folders.remove(spark, file)
    spark.sql(f"alter table {table} recover partitions")
    spark.catalog.refreshTable(table)
    if intent["source"]:
        spark.catalog.refreshTable(intent["source"])
        other = f"{location(spark, intent['source'])}/{FOLDER}/{intent['name']}.json"
        folders.remove(spark, other)
    folders.remove(spark, intent["staged"])
