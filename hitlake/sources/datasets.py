"""Named datasets, aliases that stand for several of them, and reports about both."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.rows import literal_rows
from ..functions.schema import describe_schema
from ..operators.predicates import field_type, query_column
from ..operators.profile import date_bounds, date_texts
from .hits import read_hits
from .lines import read_lines

INDEX = "_index"


@dataclass(frozen=True)
class Dataset:
    """Files of one format: ``parquet``, or ``json`` for line-delimited JSON."""

    path: str
    format: str = "parquet"
    schema: T.StructType | None = None


@dataclass(frozen=True)
class Member:
    """A dataset in an alias, optionally narrowed by a query body."""

    index: str
    filter: Mapping[str, Any] | None = None


@dataclass(frozen=True)
class Catalog:
    datasets: Mapping[str, Dataset]
    aliases: Mapping[str, Sequence[Member]] = field(default_factory=dict)

    def members(self, name: str) -> list[Member]:
        """What a name stands for: an alias, a dataset, or all datasets a pattern matches."""
        if name in self.aliases:
            return list(self.aliases[name])
        if name in self.datasets:
            return [Member(name)]
        matched = [n for n in self.datasets if re.fullmatch(glob_regex(name), n)]
        if "*" not in name or not matched:
            raise KeyError(f"Index not found: {name}")
        return [Member(n) for n in matched]


def glob_regex(pattern: str) -> str:
    """A ``*`` pattern as an anchored regular expression."""
    return "^" + ".*".join(re.escape(part) for part in pattern.split("*")) + "$"


def like(column: Column, pattern: str | None) -> Column:
    """Names a ``*`` pattern matches; all of them without one."""
    return F.lit(True) if pattern is None else column.rlike(glob_regex(pattern))


def read_dataset(spark: SparkSession, dataset: Dataset) -> DataFrame:
    if dataset.format == "parquet":
        reader = spark.read.schema(dataset.schema) if dataset.schema else spark.read
        return reader.parquet(dataset.path)
    if dataset.format == "json":
        return read_hits(spark, dataset.path, schema=dataset.schema)
    raise ValueError(f"unknown dataset format: {dataset.format}")


def _member_rows(spark: SparkSession, catalog: Catalog, member: Member) -> DataFrame:
    rows = read_dataset(spark, catalog.datasets[member.index])
    if member.filter is not None:
        rows = rows.where(query_column(rows.schema, member.filter))
    return rows.select("*", F.lit(member.index).alias(INDEX))


def _union(spark: SparkSession, catalog: Catalog, members: Sequence[Member]) -> DataFrame:
    """A scan per member, for members whose folders or types don't go into one."""
    parts = [_member_rows(spark, catalog, member) for member in members]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_alias(spark: SparkSession, catalog: Catalog, name: str) -> DataFrame:
    """Rows of a dataset, an alias or a name pattern, with their dataset in ``_index``.

    Members need not have the same columns; each member's filter applies to its rows alone. All
    members of a format are read by one scan, whatever their number: a row's member follows from
    its file, and filters are one CASE with a branch for each different one.
    """
    members = catalog.members(name)
    kinds: dict[tuple, list[Member]] = {}
    for member in members:
        dataset = catalog.datasets[member.index]
        kinds.setdefault((dataset.format, dataset.schema and dataset.schema.json()), []).append(member)
    parts = [_one_scan(spark, catalog, same) for same in kinds.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _one_scan(spark: SparkSession, catalog: Catalog, members: Sequence[Member]) -> DataFrame:
    """The rows of members of one format and schema."""
    if len({member.index for member in members}) < max(2, len(members)):  # one, or one with several filters
        return _union(spark, catalog, members)
    datasets = [catalog.datasets[member.index] for member in members]
    paths = sorted({dataset.path.rstrip("/") for dataset in datasets})
    if len(_outermost(paths)) < len(paths):  # a folder inside another one would be read twice
        return _union(spark, catalog, members)
    file = "file of the row"
    if datasets[0].format == "json":
        rows = read_hits(spark, *paths, schema=datasets[0].schema, file_column=file)
        files = read_lines(spark, *paths).inputFiles()
    elif datasets[0].format == "parquet":
        reader = spark.read.schema(datasets[0].schema) if datasets[0].schema else spark.read.option("mergeSchema", "true")
        try:
            scan = reader.parquet(*paths)
        except Exception as failed:  # types that can't be merged, folders that are partitioned each in a way of its own
            if not re.search("MERGE_INCOMPATIBLE|CANNOT_MERGE|merge|CONFLICTING|onflicting", str(failed)):
                raise
            return _union(spark, catalog, members)
        rows = scan.select("*", F.col("_metadata.file_path").alias(file))
        files = scan.inputFiles()
    else:
        raise ValueError(f"unknown dataset format: {datasets[0].format}")
    owners = _owners(spark, files, [(member.index, dataset) for member, dataset in zip(members, datasets)])
    places = [key for key in ("folder", "file") if owners[key]]
    if sum(len(found) for found in owners.values()) > MOST_OWNERS:
        return _union(spark, catalog, members)
    for key in places:
        table = pa.table({f"{key} of member": list(owners[key]), f"{key} members": list(owners[key].values())})
        rows = rows.join(F.broadcast(spark.createDataFrame(table)), _place(F.col(f"`{file}`"), key) == F.col(f"`{key} of member`"), "left")
    found = F.concat(*[F.coalesce(f"`{key} members`", F.array().cast("array<string>")) for key in places])
    wanted = [c for c in rows.columns if c not in (file, *(f"{key} {what}" for key in places for what in ("of member", "members")))]
    rows = rows.select(*(F.col(f"`{c}`") for c in wanted), F.explode(found).alias(INDEX))
    return rows.where(_member_filters(rows, members))


#: Folders and files that are told apart by a broadcast table at most: some 20 MB.
MOST_OWNERS = 100_000


def _place(file: Column, key: str) -> Column:
    """A file's path, or the folder around it, as :func:`_plain_path` spells it."""
    path = F.regexp_replace(file, r"^(\w+):/+", "$1:/")
    return path if key == "file" else F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def _owners(spark: SparkSession, files: Sequence[str], chosen: Sequence[tuple[str, Dataset]]) -> dict[str, dict[str, list[str]]]:
    """The datasets of every folder with files in it, and of every file that is a dataset itself."""
    roots: dict[str, list[str]] = {}
    for index, dataset in chosen:
        roots.setdefault(_root(spark, dataset.path), []).append(index)
    out: dict[str, dict[str, list[str]]] = {"folder": {}, "file": {}}
    for listed in set(files):
        whole = re.sub(r"^(\w+):/+", r"\1:/", listed)
        for spelled in {whole, unquote(whole)}:  # a row's path may have its blanks written out or not
            file = unquote(spelled)
            if file in roots:
                out["file"][spelled] = roots[file]
            folder, around = spelled.rpartition("/")[0], file.split("/")[:-1]
            owning = [index for n in range(len(around)) for index in roots.get("/".join(around[: n + 1]), ())]
            if owning and folder not in out["folder"]:
                out["folder"][folder] = owning
    return out


def _member_filters(rows: DataFrame, members: Sequence[Member]) -> Column:
    """Whether a row passes its member's filter: a branch for each different filter."""
    narrowed: dict[str, tuple[Mapping[str, Any], list[str]]] = {}
    for member in members:
        if member.filter is not None:
            narrowed.setdefault(json.dumps(member.filter, sort_keys=True, default=str), (member.filter, []))[1].append(member.index)
    condition = None
    for body, names in narrowed.values():
        test, passes = F.col(INDEX).isin(names), query_column(rows.schema, body)
        condition = F.when(test, passes) if condition is None else condition.when(test, passes)
    return F.lit(True) if condition is None else F.coalesce(condition.otherwise(True), F.lit(False))


def aliases(spark: SparkSession, catalog: Catalog, pattern: str | None = None) -> DataFrame:
    """One row per alias and member: alias, index, filter."""
    rows = [
        (alias, member.index, "*" if member.filter is not None else "-")
        for alias, members in catalog.aliases.items()
        for member in members
    ]
    listed = literal_rows(spark, rows, "alias string, index string, filter string")
    return listed.where(like(F.col("alias"), pattern)).orderBy("alias", "index")


def _file_facts(spark: SparkSession, name: str, dataset: Dataset) -> DataFrame:
    """Per file of a dataset its size and time; listed only, no content is read."""
    files = spark.read.format("binaryFile").load(dataset.path)
    return files.select(
        F.lit(name).alias("index"),
        F.lit(0).cast("bigint").alias("docs"),
        F.col("length").alias("bytes"),
        F.lit(1).cast("bigint").alias("files"),
        F.col("modificationTime").alias("created"),
    )


def _outermost(paths: Sequence[str]) -> list[str]:
    """Paths without those inside another one, so that no file is listed twice."""
    distinct = sorted({path.rstrip("/") for path in paths})
    return [p for p in distinct if not any(p.startswith(q + "/") for q in distinct)]


def _plain_path(place: str) -> str:
    """``scheme:/path`` without escapes."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(place))


def _root(spark: SparkSession, path: str) -> str:
    """A dataset's place as file paths spell it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    return _plain_path(whole.toUri().toString())


def _roots(spark: SparkSession, chosen: Sequence[tuple[str, Dataset]]) -> DataFrame:
    """(index, root): the datasets with their places as file paths spell them."""
    return literal_rows(spark, [(name, _root(spark, dataset.path)) for name, dataset in chosen], "index string, root string")


def _under_roots(files: DataFrame, roots: DataFrame) -> DataFrame:
    """Files (``file``) with every dataset they belong to: that of the file or of a folder around it."""
    steps = F.split("file", "/")
    around = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    return files.select("*", F.explode(around).alias("root")).join(roots, "root").drop("root")


def _plain_file() -> Column:
    return F.regexp_replace("_metadata.file_path", r"^(\w+):/+", "$1:/").alias("file")


def _listing(spark: SparkSession, chosen: Sequence[tuple[str, Dataset]]) -> DataFrame:
    """Per file and dataset its size and time: one listing of all places, no content is read."""
    listed = spark.read.format("binaryFile").load(_outermost([d.path for _, d in chosen])).select(
        _plain_file(), F.col("length").alias("bytes"), F.col("modificationTime").alias("created"), F.lit(1).cast("bigint").alias("files")
    )
    return _under_roots(listed, _roots(spark, chosen))


def _catalog_facts(spark: SparkSession, chosen: Sequence[tuple[str, Dataset]]) -> DataFrame:
    """Facts per file and dataset: one listing of all files, and one count of rows for each format."""
    file = _plain_file()
    counts = []
    for format in sorted({d.format for _, d in chosen}):
        paths = _outermost([d.path for _, d in chosen if d.format == format])
        if format == "json":
            rows = read_lines(spark, *paths).where(F.trim("value") != "")
        else:  # with no column asked for, Parquet counts come from the footers
            rows = spark.read.schema(T.StructType([])).parquet(*paths)
        own = _roots(spark, [(n, d) for n, d in chosen if d.format == format])
        counts.append(_under_roots(rows.groupBy(file).agg(F.count(F.lit(1)).alias("docs")), own))
    facts = [_listing(spark, chosen), *counts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)


def inventory(
    spark: SparkSession,
    catalog: Catalog,
    pattern: str | None = None,
    sort: str = "created",
    descending: bool = False,
) -> DataFrame:
    """Datasets with their documents, bytes, files and creation time, ordered by one column."""
    regex = None if pattern is None else re.compile(glob_regex(pattern))
    chosen = [(n, d) for n, d in catalog.datasets.items() if regex is None or regex.fullmatch(n)]
    if not chosen:
        return literal_rows(
            spark, [], "index string, docs bigint, bytes bigint, files bigint, created timestamp"
        )
    totals = (
        _catalog_facts(spark, chosen)
        .groupBy("index")
        .agg(
            F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"),
            F.sum("bytes").alias("bytes"),
            F.sum("files").alias("files"),
            F.min("created").alias("created"),
        )
    )
    key = F.col(sort)
    return totals.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), "index")


def describe_dataset(
    spark: SparkSession, catalog: Catalog, name: str, time_field: str = "@timestamp"
) -> DataFrame:
    """One row about a dataset: its inventory and the range and span of its times."""
    dataset = catalog.datasets.get(name)
    if dataset is None:
        raise KeyError(f"Index not found: {name}")
    rows = read_dataset(spark, dataset)
    index = F.lit(name).alias("index")
    times = rows.agg(F.count(F.lit(1)).alias("docs"), *date_bounds(rows, time_field)).select(index, "*")
    facts = _file_facts(spark, name, dataset).unionByName(times, allowMissingColumns=True)
    totals = facts.groupBy("index").agg(
        F.sum("docs").alias("docs"),
        F.sum("bytes").alias("bytes"),
        F.sum("files").alias("files"),
        F.min("created").alias("created"),
        F.min("oldest").alias("oldest"),
        F.max("newest").alias("newest"),
    )
    times_shown = date_texts(field_type(rows.schema, time_field))
    return totals.select("index", "docs", "bytes", "files", "created", *times_shown)


def dataset_schema(spark: SparkSession, catalog: Catalog, name: str) -> DataFrame:
    """Columns of a dataset, for the report of :func:`describe_dataset`."""
    return describe_schema(read_dataset(spark, catalog.datasets[name]))


def describe_alias(
    spark: SparkSession, catalog: Catalog, name: str, time_field: str = "@timestamp"
) -> DataFrame:
    """One row per member with its documents, times, bytes, files and creation, and the range over all members.

    Documents and times are those that pass the member's filter; bytes, files and creation are the
    whole dataset's. One aggregation over the union; the overall range is taken from its few rows.
    """
    members = catalog.members(name)
    rows = read_alias(spark, catalog, name)
    data_type = field_type(rows.schema, time_field)
    per_member = rows.groupBy(INDEX).agg(
        F.count(F.lit(1)).alias("docs"), *date_bounds(rows, time_field)
    )
    names = sorted({m.index for m in members})
    listed = spark.createDataFrame(pa.table({INDEX: names}))
    facts = _listing(spark, [(n, catalog.datasets[n]) for n in names])
    facts = facts.groupBy(F.col("index").alias(INDEX)).agg(
        F.sum("bytes").alias("bytes"), F.sum("files").alias("files"), F.min("created").alias("created")
    )
    everyone = Window.partitionBy()
    joined = listed.join(per_member, INDEX, "left").join(facts, INDEX, "left").select(
        INDEX,
        F.coalesce("docs", F.lit(0)).alias("docs"),
        F.struct("bytes", "files", "created").alias("facts"),
        "oldest",
        "newest",
        F.min("oldest").over(everyone).alias("all_oldest"),
        F.max("newest").over(everyone).alias("all_newest"),
    )
    own = joined.select(
        INDEX, "docs", "facts", *date_texts(data_type), "all_oldest", "all_newest"
    )
    overall = own.withColumnsRenamed(
        {"oldest": "member_oldest", "newest": "member_newest", "span": "member_span"}
    ).withColumnsRenamed({"all_oldest": "oldest", "all_newest": "newest"})
    return overall.select(
        F.col(INDEX).alias("index"),
        "docs",
        "facts.*",
        "member_oldest",
        "member_newest",
        "member_span",
        F.lit(len(members)).cast("bigint").alias("members"),
        *date_texts(data_type),
    )
