"""Upserts by merge-on-read (S6, T3): a table as sorted runs.

An upsert replaces whole rows, so it never has to read what it replaces: a
batch is written as a *run* of its own (one row per key, the last one wins)
and its cost depends on the batch alone.  A reader takes, per key, the row of
the newest run.

    data/run=N/key_range=K     the run's rows, in files sorted by key
    stats/run=N                per key range: Bloom filter, smallest and largest key
    current/N.json             the runs that make up version N (a few numbers each)
    consumers/NAME/N.json      the version up to which a reader of changes has come

A version is published by renaming its ``current`` file into place; a run has
the number of the version that brings it in.  A crash before that leaves a
folder that the next version overwrites, so readers see the state before or
after, never a part.  One writer at a time.

Runs of similar size are merged once there are ``FAN_IN`` of them (size-tiered
compaction), so a table of n rows has about ``FAN_IN * log(n)`` runs and a row
is rewritten about log(n) times in its life.  :func:`compact` publishes like an
upsert; a version's files stay until two later versions exist.

Reading doesn't shuffle the table: all runs but the largest are reduced to
their newest rows by key, and the largest loses those keys by an anti join.
:func:`changes` compares two versions: the later one's new runs hold every key
that may differ, so the table isn't read for it.  A consumer's bookmark keeps
the version it names, whatever is compacted meanwhile.
:func:`lookup` opens only the key ranges of those runs whose Bloom filters
(built by Spark's bitmap aggregates) and key bounds may hold a key.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import assign_keys, first_per_key, last_per_key, with_defaults
from ..session import checkpoint_dir
from .tables import _folder, _published, key_range, publish

FAN_IN = 8                    # runs of one tier that are merged
TIER_BASE = 1 << 10           # rows of the smallest tier
BLOOM_HASHES, BLOOM_BITS_PER_KEY = 4, 10
PAGE_BITS = 1 << 15           # bits of one Bloom page (a bitmap of Spark's aggregates)
SLICE = 62_500                # width of the slices in which a key range of sequential ids is written


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{path}/current/{version}.json", wholetext=True).first()[0])


def _current(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(last published version, its manifest); (-1, no runs) before the first."""
    versions = _published(spark, path)
    return (versions[-1], _manifest(spark, path, versions[-1])) if versions else (-1, {"runs": [], "schema": None})


def runs(spark: SparkSession, path: str) -> list[dict]:
    """The published runs, oldest first: ``run``, ``rows``.  About FAN_IN * log(rows) entries."""
    return _current(spark, path)[1]["runs"]


# ------------------------------------------------------------------ Bloom
def _positions(key: Column, bits: Column) -> Column:
    """(hash number, bit 1 .. bits) of every hash of a key."""
    return F.array(*[F.struct(F.lit(i).alias("hash"), (F.pmod(F.xxhash64(F.lit(i), key), bits) + 1).alias("bit")) for i in range(BLOOM_HASHES)])


def _page(bit: Column) -> Column:
    return F.floor((bit - 1) / PAGE_BITS).cast("long")


def _is_set(bitmap: Column, bit: Column) -> Column:
    at = F.pmod(bit - 1, F.lit(PAGE_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0


def _write_stats(spark: SparkSession, path: str, run: int, key: str, part_col: str) -> int:
    """Bloom filter and key bounds per key range of a written run; returns its rows."""
    keys = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data/run={run}").select(part_col, F.col(key).alias("key"))
    # One row per key range (a million orders).
    sizes = keys.groupBy(part_col).agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("lo"), F.max("key").alias("hi"),
                                       (F.ceil(F.count(F.lit(1)) * BLOOM_BITS_PER_KEY / PAGE_BITS) * PAGE_BITS).cast("long").alias("bits"))
    marks = (keys.join(sizes.select(part_col, "bits"), part_col).select(part_col, F.explode(_positions(F.col("key"), F.col("bits"))).alias("at"))
             .groupBy(part_col, _page(F.col("at.bit")).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at.bit")).alias("bitmap")))
    marks.join(sizes, part_col).write.mode("overwrite").parquet(f"{path}/stats/run={run}")
    return keys.count()                  # from the files' footers


def _write_run(spark: SparkSession, path: str, run: int, rows: DataFrame, key: str, part_col: str) -> int:
    # A batch has few key ranges of sequential ids, so each is written in slices, by all cores, and read
    # by them; small slices go to one task.  Other partitions (buckets) are many and stay whole.
    # Nothing reads this folder before it is published.
    at = F.when(F.col(part_col) == key_range()(F.col(key)), key_range(width=SLICE)(F.col(key)))
    rows.repartition(part_col, at).sortWithinPartitions(part_col, key).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy(part_col).parquet(f"{path}/data/run={run}")
    return _write_stats(spark, path, run, key, part_col)


def _publish(spark: SparkSession, path: str, version: int, current: list[dict], schema: dict) -> None:
    publish(spark, f"{path}/current", f"{version}.json", json.dumps({"runs": current, "schema": schema}))
    _remove_superseded(spark, path, version)


def _remove_superseded(spark: SparkSession, path: str, version: int) -> None:
    """Drop versions before the last two that no bookmark names, and the runs only they name."""
    published, named = _published(spark, path), set(_bookmarks(spark, path).values())
    old = [v for v in published if v < version - 1 and v not in named]
    kept = {r["run"] for v in published if v not in old for r in _manifest(spark, path, v)["runs"]}
    for v in old:
        for r in _manifest(spark, path, v)["runs"]:
            if r["run"] not in kept:
                for part in ("data", "stats"):
                    fs, folder = _folder(spark, f"{path}/{part}/run={r['run']}")
                    fs.delete(folder, True)
        fs, file = _folder(spark, f"{path}/current/{v}.json")
        fs.delete(file, False)


# ----------------------------------------------------------------- writing
def _add_run(spark: SparkSession, path: str, last: int, manifest: dict, rows: DataFrame, key: str, part_col: str, surrogate: str | None) -> int:
    version = last + 1
    n = _write_run(spark, path, version, rows, key, part_col)
    entry = {"run": version, "rows": n}
    if surrogate:
        entry["high"] = spark.read.parquet(f"{path}/data/run={version}").agg(F.max(surrogate)).first()[0]
    # Columns of older runs that this one lacks stay (NULL in its rows).
    fields = rows.schema.jsonValue()["fields"]
    names = {f["name"] for f in fields}
    fields += [f for f in (manifest["schema"] or {"fields": []})["fields"] if f["name"] not in names]
    _publish(spark, path, version, [*manifest["runs"], entry], {"type": "struct", "fields": fields})
    return n


def upsert(spark: SparkSession, path: str, incoming: DataFrame, key: str, order_col: str, part_col: str = "key_range",
           partition_of=None, now: Column | None = None, stamp_col: str | None = "ingestion_ts", surrogate: str | None = None) -> int | None:
    """Publish the batch's last row per key as a new run.  Returns its rows,
    None for an empty batch (which changes nothing).  ``surrogate`` names the
    key column whose largest value the manifest shall carry."""
    partition_of = partition_of or key_range()
    rows = last_per_key(incoming, key, order_col).drop(order_col)
    if stamp_col:
        rows = rows.withColumn(stamp_col, now if now is not None else F.current_timestamp())
    if incoming.isEmpty():
        return None
    last, manifest = _current(spark, path)
    n = _add_run(spark, path, last, manifest, rows.withColumn(part_col, partition_of(F.col(key))), key, part_col, surrogate)
    return n


def hash_buckets(n: int = 1024):
    """Partition function for natural keys: a bucket by the key's hash."""
    return lambda key: F.pmod(F.xxhash64(key), F.lit(n)).cast("long")


def insert_ignore(spark: SparkSession, path: str, incoming: DataFrame, key: str, order_col: str, surrogate: str | None = None,
                  defaults: dict | None = None, part_col: str = "key_range", partition_of=None) -> int:
    """Publish the rows whose natural key is new (the first one per key) as
    a run and return their number.

    The table is its own index: keys lie in hash buckets, and only the buckets
    of those runs are opened whose Bloom filters may hold a key of the batch,
    for the key column alone.  Surrogate keys go on after the largest one,
    which the manifest carries.  A replayed batch finds its keys and adds nothing.
    """
    partition_of = partition_of or hash_buckets()
    last, manifest = _current(spark, path)
    k = F.col(key)
    checked = incoming.withColumn(key, F.when(k.isNull(), F.raise_error(F.lit(f"NULL {key} in an insert batch"))).otherwise(k))
    checkpoint_dir(spark)
    # Written once: it is looked up, counted and numbered.
    fresh = first_per_key(checked, key, order_col).checkpoint()
    folders = _folders(path, candidates(spark, path, fresh, key, part_col, partition_of, manifest["runs"]), part_col) if manifest["runs"] else []
    if folders:
        present = _rows(spark, path, manifest, manifest["runs"], folders).select(key)
        fresh = fresh.join(present, key, "left_anti").checkpoint()
    n = fresh.count()
    if not n:
        return 0
    high = max((r.get("high") or 0 for r in manifest["runs"]), default=0)
    rows = with_defaults(assign_keys(fresh, surrogate, order_col, high) if surrogate else fresh, defaults or {}).drop(order_col)
    rows = rows.withColumn(part_col, partition_of(F.col(key)))
    _add_run(spark, path, last, manifest, rows, key, part_col, surrogate)
    return n


def _folders(path: str, pairs: DataFrame, part_col: str) -> list[str]:
    """Folders of (run, key range) pairs, by name: at most keys times runs."""
    return [f"{path}/data/run={r['run']}/{part_col}={r[part_col]}" for r in sorted(pairs.collect())]


def _tier(rows: int) -> int:
    return max(0, math.floor(math.log(max(rows, 1) / TIER_BASE, FAN_IN)) + 1)


def due(current: list[dict], fan_in: int = FAN_IN) -> list[dict]:
    """The runs to merge next: neighbours in age (else an older row could
    overtake a newer one), the smallest tier first."""
    for tier in sorted({_tier(r["rows"]) for r in current}):
        # From the newest backwards: the runs of this tier and the smaller ones between them.
        tail = []
        for r in reversed(current):
            if _tier(r["rows"]) > tier:
                break
            tail.append(r)
        if sum(_tier(r["rows"]) == tier for r in tail) >= fan_in:
            return tail[::-1]
    return []


def compact(spark: SparkSession, path: str, key: str = "order_id", part_col: str = "key_range", fan_in: int = FAN_IN) -> list[int]:
    """Merge the runs of one full tier, if there is one; returns their numbers."""
    last, manifest = _current(spark, path)
    merged = due(manifest["runs"], fan_in)
    if not merged:
        return []
    version, numbers = last + 1, [r["run"] for r in merged]
    n = _write_run(spark, path, version, _newest(spark, path, manifest, merged, key), key, part_col)
    # The merged runs are the newest ones, so the new one comes last.
    entry = {"run": version, "rows": n}
    if any("high" in r for r in merged):
        entry["high"] = max(r.get("high") or 0 for r in merged)
    _publish(spark, path, version, [r for r in manifest["runs"] if r["run"] not in numbers] + [entry], manifest["schema"])
    return numbers


# ----------------------------------------------------------------- changes
def version(spark: SparkSession, path: str) -> int:
    """The last published version; -1 before the first."""
    return _current(spark, path)[0]


def _marks(spark: SparkSession, path: str, consumer: str) -> list[int]:
    fs, folder = _folder(spark, f"{path}/consumers/{consumer}")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _bookmarks(spark: SparkSession, path: str) -> dict[str, int]:
    fs, folder = _folder(spark, f"{path}/consumers")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return {n: marks[-1] for n in names if (marks := _marks(spark, path, n))}


def bookmark(spark: SparkSession, path: str, consumer: str) -> int:
    """The version up to which ``consumer`` has come; -1 for a new one, which gets all rows."""
    marks = _marks(spark, path, consumer)
    return marks[-1] if marks else -1


def advance(spark: SparkSession, path: str, consumer: str, to: int) -> None:
    """Move the bookmark to version ``to``, which is kept from then on; the
    version of the older bookmark goes with the next publication."""
    marks = _marks(spark, path, consumer)
    if marks and to <= marks[-1]:
        if to < marks[-1]:
            raise ValueError(f"bookmark of {consumer} is at {marks[-1]}, past {to}")
        return
    publish(spark, f"{path}/consumers/{consumer}", f"{to}.json", "{}")
    if to >= 0 and to not in _published(spark, path):
        raise FileNotFoundError(f"version {to} of {path} is gone; {consumer} has to start from -1 under a new name")
    for old in marks:
        fs, file = _folder(spark, f"{path}/consumers/{consumer}/{old}.json")
        fs.delete(file, False)


def changes(spark: SparkSession, path: str, since: int, until: int | None = None, key: str = "order_id",
            part_col: str = "key_range", partition_of=None, ignore: tuple[str, ...] = ("ingestion_ts",)) -> DataFrame:
    """Rows of version ``until`` (default: the last) that version ``since`` lacks
    or holds otherwise, with ``change``: ``insert`` or ``update``.  A row sent
    again without a difference outside ``ignore`` is no change; -1 is the empty table."""
    until = version(spark, path) if until is None else until
    published = _published(spark, path)
    for v in {since, until} - {-1}:
        if v not in published:
            raise FileNotFoundError(f"version {v} of {path} is gone; a bookmark keeps the version it names")
    after = _manifest(spark, path, until) if until >= 0 else None
    if after is None:
        raise FileNotFoundError(f"no published table at {path}")
    before = _manifest(spark, path, since) if since >= 0 else {"runs": [], "schema": None}
    known = {r["run"] for r in before["runs"]}
    new_runs = [r for r in after["runs"] if r["run"] not in known]
    if not new_runs:
        return _newest(spark, path, after, after["runs"], key).drop(part_col).limit(0).withColumn("change", F.lit("update"))
    # Compaction merges the newest runs, so the new ones are the newest: their rows are those of ``until``.
    rows = _newest(spark, path, after, new_runs, key).drop(part_col)
    folders = []
    if before["runs"]:
        folders = _folders(path, candidates(spark, path, rows, key, part_col, partition_of, before["runs"]), part_col)
    if not folders:
        return rows.withColumn("change", F.lit("insert"))
    held = _rows(spark, path, before, before["runs"], folders).join(rows.select(key), key, "left_semi")
    held = last_per_key(held, key, "_age").drop("_age")
    compared = [c for c in rows.columns if c not in (key, *ignore)]
    # A column that came later was NULL in every older row.
    state = F.struct(*[F.col(c) if c in held.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in compared])
    old = held.select(F.col(key).alias("_key"), state.alias("_old"))
    same = F.col("_old").eqNullSafe(F.struct(*map(F.col, compared)))
    return (rows.join(old, rows[key] == old["_key"], "left").filter(F.col("_key").isNull() | ~same)
            .withColumn("change", F.when(F.col("_key").isNull(), "insert").otherwise("update")).drop("_key", "_old"))


# ----------------------------------------------------------------- reading
def _rows(spark: SparkSession, path: str, manifest: dict, some: list[dict], folders: list[str] | None = None) -> DataFrame:
    """Rows of the runs ``some`` with ``_age``, their place among them; the
    schema is the manifest's, so no file is opened for it."""
    schema = T.StructType.fromJson(manifest["schema"]).add("run", "long")
    age = F.create_map(*[F.lit(x) for i, r in enumerate(some) for x in (r["run"], i)])
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*(folders or [f"{path}/data/run={r['run']}" for r in some]))
    return rows.withColumn("_age", age[F.col("run").cast("int")]).drop("run")


def _newest(spark: SparkSession, path: str, manifest: dict, some: list[dict], key: str) -> DataFrame:
    """The newest row per key of the runs ``some`` (oldest first)."""
    largest = max(range(len(some)), key=lambda i: some[i]["rows"])
    big = _rows(spark, path, manifest, some[largest:largest + 1]).drop("_age")
    rest = [r for i, r in enumerate(some) if i != largest]
    if not rest:
        return big
    # The others, one row per key; those older than the largest run lose to it as well.
    top = last_per_key(_rows(spark, path, manifest, rest), key, "_age")
    newer = top.filter(F.col("_age") >= largest).drop("_age")
    if largest:
        older = top.filter(F.col("_age") < largest).drop("_age")
        newer_or_only = newer.unionByName(older.join(big.select(key), key, "left_anti"))
    else:
        newer_or_only = newer
    return big.join(newer.select(key), key, "left_anti").unionByName(newer_or_only)


def read(spark: SparkSession, path: str, key: str = "order_id") -> DataFrame:
    """The table as last published."""
    _, manifest = _current(spark, path)
    if not manifest["runs"]:
        raise FileNotFoundError(f"no published table at {path}")
    return _newest(spark, path, manifest, manifest["runs"], key)


def candidates(spark: SparkSession, path: str, keys: DataFrame, key: str = "order_id", part_col: str = "key_range",
               partition_of=None, current: list[dict] | None = None) -> DataFrame:
    """(run, key range) pairs that may hold one of ``keys``."""
    partition_of = partition_of or key_range()
    current = runs(spark, path) if current is None else current
    stats = spark.read.option("basePath", f"{path}/stats").parquet(*[f"{path}/stats/run={r['run']}" for r in current])
    asked = keys.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct().withColumn(part_col, partition_of(F.col("key")))
    sizes = stats.select("run", part_col, "bits", "lo", "hi").distinct()
    bits = (asked.join(sizes, part_col).filter("key BETWEEN lo AND hi")
            .select("run", part_col, "key", F.explode(_positions(F.col("key"), F.col("bits"))).alias("at"))
            .withColumn("page", _page(F.col("at.bit"))))
    hits = bits.join(stats.select("run", part_col, "page", "bitmap"), ["run", part_col, "page"]).filter(_is_set(F.col("bitmap"), F.col("at.bit")))
    return hits.groupBy("run", part_col, "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == BLOOM_HASHES).select("run", part_col).distinct()


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "order_id", part_col: str = "key_range", partition_of=None) -> DataFrame:
    """The newest rows of ``keys``; opens only folders that may hold one.  The
    folders' names reach the driver: at most keys times runs."""
    _, manifest = _current(spark, path)
    current = manifest["runs"]
    if not current:
        raise FileNotFoundError(f"no published table at {path}")
    folders = _folders(path, candidates(spark, path, keys, key, part_col, partition_of, current), part_col)
    if not folders:
        return read(spark, path, key).limit(0)
    rows = _rows(spark, path, manifest, current, folders)
    return last_per_key(rows.join(keys.select(key).distinct(), key, "left_semi"), key, "_age").drop("_age")
