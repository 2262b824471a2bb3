"""A stored state per person, kept up to date from published days without reading old ones again.

The daily tables ``orders``, ``customers`` and ``payments`` are published together (``versions``). An update compares the newest
version with what it has seen: days that are new, were rewritten or came late are read, and summarised per person in a table
of their own, the day's summary. The state up to a day merges such summaries; smallest and largest values cannot be taken
back, so a changed day is replayed from the newest state before it, with the small summaries of the days since.

States are bucketed by person. The merge with new days moves those days only, not the state.

Batches need not be calendar days: a batch is named by its first day, and holds nothing older. The rows of an order, its customer
link and its payments belong to one batch, and are joined within it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, StructType

from tidemark.columns import PERSON, STATE
from tidemark.functions.times import Snapshot, instant
from tidemark.operators.activity import PAST_MEASURES, activity, summary
from tidemark.operators.features import feature_columns
from tidemark.sources.files import DAY_COLUMNS, file_system, hadoop_path
from tidemark.sources.keyed import open_buckets, write_buckets
from tidemark.sources.tables import OrderTables, typed_customers, typed_orders, typed_payments
from tidemark.streaming.versions import VERSIONS, commit, list_versions, read_manifest, read_version

#: Buckets of a new state: about 128 MB each at some 10^10 persons need 8192. It stays as it is for the life of a state.
BUCKETS = 64
#: States that are kept to replay changed days from.
KEEP = 4

#: The person as text that is never null, so that the join finds the buckets.
KEY = "person_key"
MERGES = {STATE: F.max, **PAST_MEASURES, "frequency": F.sum}


def scoped(df: DataFrame, *ids: str) -> DataFrame:
    """Ids that hold within their batch only; ``batch`` is its first day."""
    batch = F.concat_ws("-", *DAY_COLUMNS)
    return df.withColumns({name: F.concat(batch, F.lit(":"), F.col(name).cast("string")) for name in ids} | {"batch": batch})


def batch_summaries(lake: dict[str, DataFrame]) -> DataFrame:
    """Merged measures of each batch and person."""
    orders = scoped(lake["orders"], "order_id", "customer_id")
    typed = typed_orders(orders).withColumn("batch", F.concat_ws("-", *DAY_COLUMNS)).drop(*DAY_COLUMNS)
    early = F.col("purchase_ts") < F.col("batch").cast("timestamp_ntz")
    wrong = F.raise_error(F.concat(F.lit("an order is older than its batch "), F.col("batch"))).cast("boolean")
    typed = typed.filter(F.col("purchase_ts").isNotNull() & F.when(early, wrong).otherwise(True))
    tables = OrderTables(
        typed, typed_customers(scoped(lake["customers"], "customer_id")), typed_payments(scoped(lake["payments"], "order_id"))
    )
    by_state = summary(activity(tables, keep=["batch"]), [PERSON, "batch"], PAST_MEASURES, unique_orders=False)
    people = by_state.groupBy(PERSON, "batch").agg(*merges())
    kind = people.schema["money"].dataType
    if isinstance(kind, DecimalType):
        people = people.withColumn("money", F.col("money").cast(DecimalType(38, kind.scale)))
    key = F.coalesce(F.concat(F.lit("="), F.col(PERSON).cast("string")), F.lit(""))
    return people.select(key.alias(KEY), PERSON, *MERGES, "batch")


def merges() -> list[Column]:
    return [how(name).alias(name) for name, how in MERGES.items()]


def both(name: str) -> Column:
    """The merge of a measure of the state and of newer batches; either may be missing."""
    old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
    if MERGES[name] is F.sum:
        return F.coalesce(old + new, old, new)
    return F.least(old, new) if MERGES[name] is F.min else F.greatest(old, new)


def new_manifest(buckets: int) -> dict:
    return {"buckets": buckets, "schema": None, "lake": 0, "batches": {}, "states": []}


def state_manifest(spark: SparkSession, root: str, buckets: int = BUCKETS) -> tuple[int, dict]:
    version = max(list_versions(spark, root), default=0)
    return version, read_manifest(spark, root, version) if version else new_manifest(buckets)


def batch_writes(lake: dict) -> dict[str, dict[str, str]]:
    """By batch, the write that holds each table."""
    found: dict[str, dict[str, str]] = {}
    for name in ("orders", "customers", "payments"):
        for day, write in lake.get(name, {"days": {}})["days"].items():
            found.setdefault(day, {})[name] = write
    return found


def write_summaries(summaries: DataFrame, root: str, write: str) -> set[str]:
    """Write the summaries of some batches under a fresh folder; the batches that have any."""
    path = f"{root}/summaries/write={write}"
    summaries.hint("rebalance", F.col("batch")).write.mode("error").partitionBy("batch").parquet(path)
    spark = summaries.sparkSession
    found = file_system(spark, path).globStatus(hadoop_path(spark, f"{path}/batch=*")) or []
    return {status.getPath().getName().removeprefix("batch=") for status in found}


def state_before(spark: SparkSession, root: str, manifest: dict, day: str | None = None) -> DataFrame | None:
    """The merge of all batches, or of those named by a day before ``day``: the newest stored state that lies before it and the
    summaries since. None without any."""
    schema = StructType.fromJson(manifest["schema"]) if manifest["schema"] else None
    states = [s for s in manifest["states"] if day is None or s["through"] < day]
    through = states[-1]["through"] if states else ""
    later = {d: b["summary"] for d, b in manifest["batches"].items() if d > through and (day is None or d < day) and b["summary"]}
    paths = [f"{root}/summaries/write={write}/batch={d}" for d, write in sorted(later.items())]
    old = open_buckets(spark, f"{root}/states/{states[-1]['write']}", schema, KEY, manifest["buckets"]) if states else None
    if not paths:
        return old
    new = spark.read.schema(schema).parquet(*paths).groupBy(KEY).agg(F.max(PERSON).alias(PERSON), *merges())
    new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if old is None:
        return new
    person = F.coalesce(f"old.{PERSON}", f"new.{PERSON}").alias(PERSON)
    merged = old.alias("old").join(new.alias("new"), KEY, "full_outer")
    return merged.select(KEY, person, *[both(n).cast(schema[n].dataType).alias(n) for n in MERGES])


def update(spark: SparkSession, lake: str, root: str, buckets: int = BUCKETS, keep: int = KEEP) -> list[str]:
    """Bring the state below ``root`` up to the newest version of a lake. The batches that differed, oldest first.

    Only the folders of new and rewritten batches are read, and a repeated call reads nothing. A call that dies leaves the
    state of before; of two callers at once, the one that is late compares again.
    """
    number, known = state_manifest(spark, root, buckets)
    version = max(list_versions(spark, lake), default=0)
    if version <= known["lake"]:
        return []
    wanted = batch_writes(read_manifest(spark, lake, version))
    seen = {d: b["writes"] for d, b in known["batches"].items()}
    changed = sorted(d for d in wanted.keys() | seen.keys() if wanted.get(d) != seen.get(d))
    fresh = [d for d in changed if d in wanted]
    write, manifest = uuid.uuid4().hex, known | {"lake": version}
    if fresh:
        summaries = batch_summaries(read_version(spark, lake, version, fresh))
        schema = summaries.drop("batch").schema.jsonValue()
        if known["schema"] and StructType.fromJson(known["schema"]).simpleString() != StructType.fromJson(schema).simpleString():
            raise ValueError("the columns of the tables have other types than those of the state")
        filled = write_summaries(summaries, root, write)
        manifest["schema"] = known["schema"] or schema
        batches = {d: {"writes": wanted[d], "summary": write if d in filled else None} for d in fresh}
        manifest["batches"] = {d: b for d, b in known["batches"].items() if d in wanted} | batches
    elif changed:
        manifest["batches"] = {d: b for d, b in known["batches"].items() if d in wanted}
    if changed:
        manifest["states"] = [s for s in known["states"] if s["through"] < changed[0]]
        through = manifest["states"][-1]["through"] if manifest["states"] else ""
        if any(b["summary"] and d > through for d, b in manifest["batches"].items()):
            rows = state_before(spark, root, manifest)
            # Rows merged with an older state already lie in their buckets.
            rows = rows if through else rows.repartition(manifest["buckets"], KEY)
            write_buckets(rows, f"{root}/states/{write}", KEY, manifest["buckets"])
            manifest["states"] = [*manifest["states"], {"through": max(manifest["batches"]), "write": write}][-keep:]
    if not commit(spark, root, number + 1, manifest):
        return update(spark, lake, root, buckets, keep)
    return changed


def features_at(spark: SparkSession, root: str, at: Snapshot) -> DataFrame | None:
    """Features of all persons at a snapshot that begins a batch, from the stored state. None if nothing lies before it."""
    _, manifest = state_manifest(spark, root)
    rows = state_before(spark, root, manifest, at.at.isoformat()[:10])
    if rows is None:
        return None
    late = F.raise_error(F.lit(f"a batch reaches beyond {at.label}")).cast("boolean")
    rows = rows.filter(F.when(F.col("last_ts") >= instant(at.at), late).otherwise(F.col("frequency") >= 1))
    return rows.select(*feature_columns(instant(at.at), F.lit(at.label)))


def follow(spark: SparkSession, lake: str, root: str, checkpoint: str, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """A stream that updates the state whenever a version is published; ``trigger`` as for ``writeStream.trigger``, all versions
    at hand and then an end unless given.

    A day is seen when a version names it, never while it is written. A batch of the stream that is repeated after a restart
    finds the state up to date and changes nothing.
    """

    def step(_: DataFrame, __: int) -> None:
        update(spark, lake, root, buckets)

    published = spark.readStream.schema("value string").option("wholetext", True).text(f"{lake}/{VERSIONS}")
    writer = published.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def unused_folders(spark: SparkSession, root: str) -> Iterable[str]:
    """Folders of states that the newest manifest does not name; remove them when no reader or writer is at work."""
    _, manifest = state_manifest(spark, root)
    named = {s["write"] for s in manifest["states"]}
    found = file_system(spark, root).globStatus(hadoop_path(spark, f"{root}/states/*")) or []
    return sorted(s.getPath().toString() for s in found if s.getPath().getName() not in named)
