"""Keyed tables on parquet: insert or update by key, several tables in one commit.

Layout: ``<base>/<table>/table_version=V/height_bucket=N/``. What was written once is never changed. A
commit is one small file in ``<base>/_manifest`` that names, for all tables below the base, the
versions of each bucket that are live; readers resolve buckets through the last one. Until that
file is put in place by a rename, nobody sees what a batch has written, and a batch that breaks off
at any step leaves the tables as they were. A plan holds the files of the commit it was built on,
so later commits do not change what it reads.

A batch is written once, as a version of the buckets it touches. Which buckets may hold one of its keys
is told by an index of the keys' hashes, 8 bytes a key, that each commit adds to; other buckets are
not opened. Of the stored parts only those with known keys are rewritten, without these keys. Parts of a bucket that have become many are
joined, and :meth:`Versions.clean` removes what no recent commit names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinfold.operators.coerce import SEQUENCE
from coinfold.operators.rows import conform
from coinfold.schemas import LEGACY_MARKER, TABLE_KEYS, TABLES
from coinfold.session import KEPT_COMPRESSION, dropping_shuffles
from coinfold.sources import files
from coinfold.sources.raw import DEFAULT_BUCKET, with_height_bucket

BUCKET = "height_bucket"
STRATEGIES = ("update", "ignore")
VERSION = "table_version"
MANIFESTS, COMMITS = "_manifest", "_commits"
#: Beside each table lies its key index, a table like it that holds hashes of the keys by bucket.
INDEX = "_keys_"
_HASH = T.StructType([T.StructField("hash", T.LongType())])
#: A bucket of more parts than this is rewritten as one by the commit that adds the next.
MOST_PARTS = 16


def conflict_strategy(name: str = "update", fast: bool = False) -> str:
    """``update`` replaces rows with a known key, ``ignore`` keeps them. The fast mode
    never updates."""
    chosen = str(name).strip().lower()
    if chosen not in STRATEGIES:
        raise ValueError(f"unknown conflict strategy {name!r}")
    return "ignore" if fast and chosen == "update" else chosen


Parts = dict[int, list[str]]  # bucket: its live versions


class Versions:
    """The commits of the tables below one folder. The table ``""`` is the folder itself."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")

    def folder(self, table: str) -> str:
        return f"{self.base}/{table}".rstrip("/")

    def current(self) -> dict:
        """The last commit: its number, batch and the live parts of each table."""
        found = files.names(self.spark, f"{self.base}/{MANIFESTS}")
        numbers = [n for n in found if n.endswith(".json") and not n.startswith(".")]
        return self._read(numbers[-1]) if numbers else {"number": 0, "batch_id": None, "tables": {}}

    def _read(self, name: str) -> dict:
        found = json.loads(files.read(self.spark, f"{self.base}/{MANIFESTS}/{name}"))
        for table, parts in found["tables"].items():
            found["tables"][table] = {int(bucket): versions for bucket, versions in parts.items()}
        return found

    def put(self, based_on: dict, tables: dict[str, Parts], batch_id: str | None = None) -> None:
        """The next commit. One that another writer has made since ``based_on`` is an error,
        and the batch has to be run again."""
        number = based_on["number"] + 1
        made = {"number": number, "batch_id": batch_id, "tables": based_on["tables"] | tables}
        files.put(self.spark, f"{self.base}/{MANIFESTS}/{number:012d}.json", json.dumps(made))

    def committed(self) -> DataFrame:
        """Ids of the batches that were committed."""
        ids = self.spark.createDataFrame([], "batch_id string")
        for folder, reader in ((COMMITS, self.spark.read), (MANIFESTS, self.spark.read)):
            if any(n.endswith(".json") for n in files.names(self.spark, f"{self.base}/{folder}")):
                found = reader.schema("batch_id string").json(f"{self.base}/{folder}/*.json")
                ids = ids.unionByName(found.where("batch_id IS NOT NULL"))
        return ids.distinct()

    def read(self, commit: dict, table: str, schema: T.StructType, parts: Parts | None = None) -> DataFrame:
        """A table as of a commit, with its bucket and version; ``parts`` takes some of it only."""
        live = commit["tables"].get(table, {}) if parts is None else parts
        paths = [
            f"{self.folder(table)}/{VERSION}={version}/{BUCKET}={bucket}"
            for bucket, versions in sorted(live.items())
            for version in versions
        ]
        full = T.StructType(
            [*schema.fields, T.StructField(BUCKET, T.LongType()), T.StructField(VERSION, T.StringType())]
        )
        if not paths:
            return self.spark.createDataFrame([], full)
        found = self.spark.read.schema(full).option("basePath", self.folder(table)).parquet(*paths)
        return found.select(*full.names)

    def write(self, table: str, rows: DataFrame) -> Parts:
        """Rows with their bucket as a new version; what was written is live once it is committed."""
        version = uuid.uuid4().hex
        path = f"{self.folder(table)}/{VERSION}={version}"
        # The hint lets adaptive execution cut large buckets and join small ones.
        with dropping_shuffles(rows.sparkSession):
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path, compression=KEPT_COMPRESSION)
        written = [n for n in files.names(self.spark, path) if n.startswith(f"{BUCKET}=")]
        return {int(n.partition("=")[2]): [version] for n in written}

    def discard(self, table: str, parts: Parts) -> None:
        """Remove versions that were written and never committed."""
        for version in {v for versions in parts.values() for v in versions}:
            files.remove(self.spark, f"{self.folder(table)}/{VERSION}={version}")

    def clean(self, keep: int = 2) -> int:
        """Remove the parts and commits that none of the last ``keep`` commits needs, and give the number
        of parts removed. Plans built on older commits cannot run any more, so no batch and no reader
        of such a plan may be under way. The ids of removed commits stay known."""
        found = [n for n in files.names(self.spark, f"{self.base}/{MANIFESTS}") if n.endswith(".json")]
        old, kept = found[:-keep], [self._read(n) for n in found[-keep:]]
        if old:
            ids = [self._read(n)["batch_id"] for n in old]
            lines = "\n".join(json.dumps({"batch_id": i}) for i in ids if i is not None)
            target = f"{self.base}/{COMMITS}/{old[-1]}"
            if lines and old[-1] not in files.names(self.spark, f"{self.base}/{COMMITS}"):
                files.put(self.spark, target, lines)
            for name in old:
                files.remove(self.spark, f"{self.base}/{MANIFESTS}/{name}")
        removed = 0
        for table in {t for commit in kept for t in commit["tables"]}:
            live = {(v, b) for commit in kept for b, vs in commit["tables"].get(table, {}).items() for v in vs}
            for name in files.names(self.spark, self.folder(table)):
                version = name.removeprefix(f"{VERSION}=")
                if version == name:
                    continue
                path = f"{self.folder(table)}/{name}"
                buckets = [n for n in files.names(self.spark, path) if n.startswith(f"{BUCKET}=")]
                gone = [n for n in buckets if (version, int(n.partition("=")[2])) not in live]
                for part in [path] if len(gone) == len(buckets) else [f"{path}/{n}" for n in gone]:
                    files.remove(self.spark, part)
                removed += len(gone)
        return removed


def joined_parts(*some: Parts) -> Parts:
    out: Parts = {}
    for parts in some:
        for bucket, versions in parts.items():
            out[bucket] = [*out.get(bucket, []), *versions]
    return out


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A keyed table with its bucket column; empty when nothing was committed yet."""
    base, _, name = path.rstrip("/").rpartition("/")
    own, shared = Versions(spark, path), Versions(spark, base)
    commit = own.current()
    if commit["number"]:
        return own.read(commit, "", schema).drop(VERSION)
    return shared.read(shared.current(), name, schema).drop(VERSION)


def one_per_key(
    batch: DataFrame, keys: tuple[str, ...], order: list[str], last: bool = True
) -> DataFrame:
    """One row per key: the last in order, or the first.

    Ties are settled by the row itself, so that a repeated run chooses the same row. An
    aggregate, so copies of one key shrink before the shuffle.
    """
    maps = [f.name for f in batch.schema.fields if isinstance(f.dataType, T.MapType)]
    # The ranked struct is the row itself, in order: nothing is carried twice. Maps have no order, their entries do.
    ranked = [*order, *[c for c in batch.columns if c not in order and c not in maps], *maps]
    rank = F.struct(*[(F.map_entries(c) if c in maps else F.col(c)).alias(f"_{i}") for i, c in enumerate(ranked)])
    chosen = F.max(rank) if last else F.min(rank)
    row = {c: F.col(f"_row._{i}") for i, c in reversed([*enumerate(ranked)])}
    return batch.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(chosen.alias("_row")).select(
        *[(F.map_from_entries(row[c]) if c in maps else row[c]).alias(c) for c in batch.columns]
    )


def write_keyed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rows: DataFrame,
    keys: tuple[str, ...],
    height: str,
    order: list[str] | None = None,
    strategy: str = "update",
    bucket_size: int = DEFAULT_BUCKET,
    batch: Batch | None = None,
) -> None:
    """Insert or update rows by key. With ``batch`` the table is one of several that commit
    together, otherwise it commits by itself.

    A key that moved to another height is found by a join of the batch keys with the key
    columns of the table; it leaves the bucket it was in.
    """
    strategy = conflict_strategy(strategy)
    order = order or [height]
    together = batch or Batch(Versions(spark, path))
    table = "" if batch is None else path.rstrip("/").rpartition("/")[2]
    bucketed = with_height_bucket(rows, height, bucket_size)
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])
    extra = [bucketed.schema[c] for c in order if c not in schema.names]
    shaped = _keyed(conform(bucketed, T.StructType([*stored.fields, *extra])), keys)
    single = one_per_key(shaped, keys, order, last=strategy == "update")
    together.merge(table, schema, single.select(*stored.names), keys, strategy)
    if batch is None:
        together.commit()


class Batch:
    """Changes of several tables that become visible together. Used with ``with``, a batch commits at
    the end; one that fails leaves the tables as they were."""

    def __init__(self, versions: Versions, batch_id: str | None = None) -> None:
        self.versions = versions
        self.batch_id = batch_id
        self.before = versions.current()
        self.tables: dict[str, Parts] = {}

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()

    def commit(self) -> None:
        self.versions.put(self.before, self.tables, self.batch_id)

    def _live(self, table: str) -> Parts:
        return self.tables.get(table, self.before["tables"].get(table, {}))

    def merge(
        self, table: str, schema: T.StructType, rows: DataFrame, keys: tuple[str, ...], strategy: str
    ) -> None:
        """Rows with unique keys into a table."""
        versions, live = self.versions, self._live(table)
        added = versions.write(table, rows)
        new = versions.read(self.before, table, schema, added)
        # Known keys first: what they are joined with then has the size of the batch, not the table.
        open_ = self._buckets_with(table, live, new, keys)
        known = versions.read(self.before, table, schema, open_).select(*keys, BUCKET, VERSION)
        held = known.join(new.select(*keys), list(keys), "left_semi")
        # One row per part with a known key: bounded by the number of parts, not by rows.
        hit = held.groupBy(BUCKET, VERSION).agg(F.count("*").alias("n")).collect() if open_ else []
        if hit and strategy == "ignore":
            kept = new.drop(VERSION).join(held.select(*keys), list(keys), "left_anti")
            fresh = versions.write(table, kept.select(*schema.names, BUCKET))
            versions.discard(table, added)
            added = fresh
        batch = added
        if hit and strategy != "ignore":
            touched: Parts = {}
            for row in hit:
                touched = joined_parts(touched, {row[BUCKET]: [row[VERSION]]})
            live = {b: [v for v in vs if v not in touched.get(b, ())] for b, vs in live.items()}
            rest = versions.read(self.before, table, schema, touched).drop(VERSION)
            rest = rest.join(new.select(*keys), list(keys), "left_anti")
            added = joined_parts(versions.write(table, rest.select(*schema.names, BUCKET)), added)
        parts = joined_parts({b: vs for b, vs in live.items() if vs}, added)
        many = {b: vs for b, vs in parts.items() if len(vs) > MOST_PARTS}
        if many:
            content = versions.read(self.before, table, schema, many).drop(VERSION)
            parts |= versions.write(table, content)
        self._index(table, versions.read(self.before, table, schema, batch), keys)
        self.tables[table] = parts

    def _buckets_with(self, table: str, live: Parts, new: DataFrame, keys: tuple[str, ...]) -> Parts:
        """The parts that may hold one of the new keys: those of the buckets where the index has its hash."""
        index = self._live(INDEX + table)
        if set(live) - set(index):  # not all of the table is indexed
            return live
        hashes = self.versions.read(self.before, INDEX + table, _HASH, index)
        found = hashes.join(new.select(F.xxhash64(*keys).alias("hash")), "hash", "left_semi")
        buckets = {r[0] for r in found.select(BUCKET).distinct().collect()} if index else set()
        return {b: vs for b, vs in live.items() if b in buckets}

    def _index(self, table: str, rows: DataFrame, keys: tuple[str, ...], replaced: Iterable[int] = ()) -> None:
        """Add the hashes of the keys to the index. It holds 8 bytes a key; a key that left its bucket stays in it,
        which costs a look into that bucket and no more."""
        name, gone = INDEX + table, set(replaced)
        hashes = rows.select(F.xxhash64(*keys).alias("hash"), BUCKET)
        old = {b: vs for b, vs in self._live(name).items() if b not in gone}
        parts = joined_parts(old, self.versions.write(name, hashes))
        many = {b: vs for b, vs in parts.items() if len(vs) > MOST_PARTS}
        if many:
            content = self.versions.read(self.before, name, _HASH, many).drop(VERSION).distinct()
            parts |= self.versions.write(name, content)
        self.tables[name] = parts

    def replace(self, table: str, content: DataFrame, buckets: Iterable[int], keys: tuple[str, ...]) -> None:
        """Put new content in place of some buckets."""
        others = {b: vs for b, vs in self._live(table).items() if b not in set(buckets)}
        made = self.versions.write(table, content)
        schema = T.StructType([f for f in content.schema.fields if f.name != BUCKET])
        self._index(table, self.versions.read(self.before, table, schema, made), keys, buckets)
        self.tables[table] = joined_parts(others, made)


def _keyed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A row without its key fails the job, as a key column takes no null."""
    return rows.withColumns(
        {
            k: F.coalesce(
                F.col(k),
                F.raise_error(F.lit(f"row without key column {k}")).cast(rows.schema[k].dataType),
            )
            for k in keys
        }
    )


# ---- the four tables ---------------------------------------------------------------------

_HEIGHTS = {
    "blocks": "height",
    "transactions": "block_height",
    "txins": "block_height",
    "txouts": "block_height",
}


CHILDREN_FIRST = ("txins", "txouts", "transactions", "blocks")


class Ledger:
    """The four keyed tables below one folder. They change together, by one commit for all."""

    def __init__(
        self, spark: SparkSession, base: str, strategy: str = "update",
        bucket_size: int = DEFAULT_BUCKET,
    ) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self.versions = Versions(spark, base)
        self.strategy = conflict_strategy(strategy)
        self.bucket_size = bucket_size

    def path(self, table: str) -> str:
        return self.versions.folder(table)

    def table(self, name: str) -> DataFrame:
        return self._at(self.versions.current(), name)

    def tables(self, buckets: set[int] | None = None) -> dict[str, DataFrame]:
        """All tables as of one commit; of ``buckets`` only, if given: others are not opened."""
        commit = self.versions.current()
        return {name: self._at(commit, name, buckets) for name in TABLES}

    def _at(self, commit: dict, name: str, buckets: set[int] | None = None) -> DataFrame:
        live = commit["tables"].get(name, {})
        parts = None if buckets is None else {b: v for b, v in live.items() if b in buckets}
        return self.versions.read(commit, name, TABLES[name], parts).drop(VERSION)

    def write(self, rows: dict[str, DataFrame], batch_id: str | None = None) -> None:
        """Write the given tables in one commit: a reader sees all of a batch or nothing of it. Of
        rows with one key the last in the input wins where the rows know their place in it. The
        commit carries ``batch_id``."""
        with Batch(self.versions, batch_id) as batch:
            for name in CHILDREN_FIRST:
                if name in rows:
                    order = [SEQUENCE] if SEQUENCE in rows[name].columns else None
                    write_keyed(
                        self.spark, self.path(name), TABLES[name], rows[name], TABLE_KEYS[name],
                        _HEIGHTS[name], order, self.strategy, self.bucket_size, batch,
                    )

    def committed(self) -> DataFrame:
        """Ids of the batches that were written completely; only these are read."""
        return self.versions.committed()

    def replace(self, tables: dict[str, DataFrame], buckets: set[int]) -> None:
        """Replace buckets of every table in one commit."""
        with Batch(self.versions) as batch:
            for name in CHILDREN_FIRST:
                if name in batch.before["tables"]:
                    content = tables[name].select(*TABLES[name].names, BUCKET)
                    batch.replace(name, content, buckets, TABLE_KEYS[name])

    def clean(self, keep: int = 2) -> int:
        """Remove what none of the last commits needs, see :meth:`Versions.clean`."""
        return self.versions.clean(keep)


# ---- layouts of earlier versions ---------------------------------------------------------


def layout_changes(existing: dict[str, list[str]]) -> list[tuple[str, str]]:
    """Renames that bring a set of tables to the present names, in order.

    A table with the marker column of the earliest layout is set aside unless that was done
    before; a second-version table takes the plain name when it is free.
    """
    names = set(existing)
    changes = []
    for table, marker in LEGACY_MARKER.items():
        if marker in existing.get(table, ()) and f"{table}_legacy" not in names:
            changes.append((table, f"{table}_legacy"))
            names = (names - {table}) | {f"{table}_legacy"}
    for table in TABLES:
        if f"{table}_v2" in names and table not in names:
            changes.append((f"{table}_v2", table))
    return changes


def migrate_catalog(spark: SparkSession, database: str = "default") -> list[tuple[str, str]]:
    """Apply :func:`layout_changes` to the tables of a catalog database."""
    existing = {
        t.name: [c.name for c in spark.catalog.listColumns(f"{database}.{t.name}")]
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
    changes = layout_changes(existing)
    for old, new in changes:
        spark.sql(f"ALTER TABLE {database}.{old} RENAME TO {database}.{new}")
    return changes
