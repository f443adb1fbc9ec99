"""Handles: a client opens collections under a root folder, a collection searches and changes records."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hybridframe import results
from hybridframe.operators import mutate, retrieve
from hybridframe.operators.approximate import CellIndex, build_cells, train_cells, write_cells
from hybridframe.operators.deltas import cells_after, changed_records, text_index_after
from hybridframe.operators.embed import HashingEmbedder, dimension_of, embed_missing
from hybridframe.operators.fulltext import TextIndex, read_index, write_index
from hybridframe.operators.hybrid import as_vectors, hybrid_search, vector_leg
from hybridframe.operators.joins import BROADCAST_ROWS, join_small
from hybridframe.operators.nearest import DEFAULT_K, nearest, nearest_batch, query_frame
from hybridframe.plans.session import ship
from hybridframe.schema import DEFAULT_DIMENSION, DOCUMENT, EMBEDDING, FIELDS, ID, METADATA, METRICS, RECORD, conform, fault, included
from hybridframe.sources.files import Files
from hybridframe.sources.markdown import source_of
from hybridframe.sources.store import BUCKETS, VARIANT, Store, Version, physical_name, typed_column

DEFAULT_DATABASE = "default"
_UNSET = object()


@dataclass(frozen=True)
class VectorConfiguration:
    """Vector size and metric of a collection."""

    dimension: int
    distance: str = "l2"

    def __post_init__(self):
        if not isinstance(self.dimension, int) or self.dimension <= 0:
            raise ValueError("dimension must be a positive integer")
        if self.distance not in METRICS:
            raise ValueError(f"distance must be one of {METRICS}")


def resolve_configuration(configuration, embedding_function) -> VectorConfiguration:
    """Vector size and metric from what was given; unset is not the same as None."""
    size = None if embedding_function is None else dimension_of(embedding_function)
    if configuration is _UNSET:
        return VectorConfiguration(size or DEFAULT_DIMENSION, "cosine")
    if configuration is None:
        if size is None:
            raise ValueError("without a configuration an embedding function is needed to tell the dimension")
        return VectorConfiguration(size, "cosine")
    if not isinstance(configuration, VectorConfiguration):
        raise TypeError(f"configuration must be a VectorConfiguration, not {type(configuration).__name__}")
    if size is not None and size != configuration.dimension:
        raise ValueError(f"configured dimension {configuration.dimension}, but the embedding function gives {size}")
    return configuration


def _questions(knn) -> int:
    """How many queries a vector leg holds; a text leg alone counts as one."""
    asked = (knn or {}).get("query_embeddings")
    if asked is None or not len(asked):
        asked = (knn or {}).get("query_texts")
    if asked is None or isinstance(asked, str) or not hasattr(asked[0], "__len__"):
        return 1
    return len(asked)


def _listed(value, one: type | tuple) -> list | None:
    return None if value is None else [value] if isinstance(value, one) else list(value)


def batch_frame(spark: SparkSession, ids, documents=None, metadatas=None, embeddings=None) -> DataFrame:
    """Lists, or single values, as a batch of records in their order."""
    ids = _listed(ids, (str, int))
    columns = {
        "documents": _listed(documents, str),
        "metadatas": _listed(metadatas, dict),
        "embeddings": None if embeddings is None else as_vectors(embeddings) if len(embeddings) else [],
    }
    if not ids:
        raise ValueError("ids must not be empty")
    for name, values in columns.items():
        if values and len(values) != len(ids):
            raise ValueError(f"{len(values)} {name} for {len(ids)} ids")
    if any(i is None or i == "" for i in ids):
        raise ValueError("an id is empty")

    def at(name: str, i: int):
        return columns[name][i] if columns[name] else None

    rows = []
    for i, ident in enumerate(ids):
        metadata = at("metadatas", i)
        rows.append((str(ident), at("documents", i), at("embeddings", i), None if metadata is None else json.dumps(metadata), i))
    return spark.createDataFrame(rows, T.StructType([*RECORD.fields, T.StructField("position", T.LongType())]))


class Collection:
    """One collection. Methods named like ``query`` return dictionaries, ``query_frame`` a DataFrame."""

    def __init__(self, client: Client, store: Store, version: Version, embedding_function):
        self._client = client
        self._store = store
        self._properties = version
        self._embedding_function = embedding_function

    @property
    def name(self) -> str:
        return self._properties.name

    @property
    def id(self) -> str:
        return physical_name(self.name)

    @property
    def dimension(self) -> int:
        return self._properties.dimension

    @property
    def distance(self) -> str:
        return self._properties.distance

    @property
    def metadata(self) -> dict:
        return {"dimension": self.dimension, "distance": self.distance}

    @property
    def embedding_function(self):
        return self._embedding_function

    @property
    def client(self) -> Client:
        return self._client

    def __repr__(self) -> str:
        return f"Collection(name={self.name!r}, dimension={self.dimension}, distance={self.distance!r})"

    # --- reading ---

    def _version(self) -> Version:
        version = self._store.version()
        if version is None:
            raise ValueError(f"collection {self.name!r} does not exist")
        return version

    def _options(self) -> dict:
        typed = {key: (F.col(typed_column(key)), family) for key, family in self._properties.typed.items()}
        return {"variant": VARIANT, "typed": typed}

    def _scan(self) -> DataFrame:
        return self._store.read(self._version())

    def records(self, version: int | None = None) -> DataFrame:
        """All records, of an older version if asked."""
        found = self._store.version(version)
        if found is None:
            raise ValueError(f"collection {self.name!r} has no version {version}")
        return self._store.read(found).select(*FIELDS)

    def create_view(self) -> str:
        """Register the records as a temporary view for SQL; returns its name."""
        self.records().createOrReplaceTempView(self.id)
        return self.id

    def get_frame(self, ids=None, where=None, where_document=None, limit=None, offset=None, include=None) -> DataFrame:
        if ids is not None and not isinstance(ids, DataFrame):
            ids = [str(i) for i in _listed(ids, (str, int))]
            scan = self._store.pick(self._version(), ids)
            return retrieve.get(scan, None, where, where_document, limit, offset, include, **self._options())
        return retrieve.get(self._scan(), ids, where, where_document, limit, offset, include, **self._options())

    def get(self, ids=None, where=None, where_document=None, limit=None, offset=None, include=None) -> dict:
        return results.flat_dict(self.get_frame(ids, where, where_document, limit, offset, include), include)

    def peek(self, limit: int = 10) -> dict:
        return results.flat_dict(retrieve.peek(self._scan(), limit), ("documents", "metadatas", "embeddings"))

    def count(self) -> int:
        return self._scan().count()

    def describe(self) -> dict:
        return retrieve.describe(self._scan(), self.name, self.dimension, self.distance).first().asDict()

    def _query_vectors(self, query_embeddings, query_texts):
        if isinstance(query_embeddings, DataFrame):
            return query_embeddings
        if query_embeddings is not None and len(query_embeddings):
            return as_vectors(query_embeddings)
        if query_texts is None or not len(query_texts):
            raise ValueError("query needs query_embeddings or query_texts")
        if self._embedding_function is None:
            raise ValueError("query_texts needs an embedding function")
        return as_vectors(self._embedding_function(_listed(query_texts, str)))

    def _nearest(self, vectors, n_results, where, where_document, include, probes) -> DataFrame:
        """Search first, reading neither texts nor metadata it does not need, then fetch the few records found."""
        scan, options = self._scan(), self._options()
        rows = n_results * (vectors.count() if isinstance(vectors, DataFrame) else len(vectors))
        if probes:
            knn, cells = {"where": where, "n_results": n_results}, self._cells(probes)
            if where_document:
                # cells hold no texts: the ids that pass are joined first, so k results are found where k records pass
                passing = retrieve.select_records(scan, None, None, where_document, **options).select(ID)
                cells = cells._replace(records=join_small(cells.records, passing, ID, "left_semi"))
            hits = vector_leg(scan, vectors, knn, self.distance, cells, **options)
        elif not isinstance(vectors, DataFrame) and len(vectors) == 1:
            hits = nearest(scan, vectors[0], n_results, self.distance, where, where_document, (), **options)
        else:
            queries = vectors if isinstance(vectors, DataFrame) else query_frame(self._store.spark, vectors)
            hits = nearest_batch(scan, queries, n_results, self.distance, where, where_document, (), **options)
        return self._fetch(hits, include, rows)

    def _fetch(self, hits: DataFrame, include, rows: int) -> DataFrame:
        """Add the included columns to at most ``rows`` hits. They are joined by bucket and id, so buckets without a hit are not read."""
        if not included(include):
            return hits
        version = self._version()
        found = hits.withColumn("bucket", self._store.bucket_of(F.col(ID), version))
        records = retrieve.project(self._store.read(version), include, ("bucket",))
        return records.join(F.broadcast(found) if rows <= BROADCAST_ROWS else found, [ID, "bucket"]).drop("bucket")

    def query_frame(
        self, query_embeddings=None, query_texts=None, n_results=DEFAULT_K, where=None, where_document=None, include=None, probes: int = 0
    ) -> DataFrame:
        """``query_id, rank, _id, distance`` and the included columns. Vectors win over texts.

        Exact unless ``probes`` is given: then that many cells of the index are searched.
        """
        vectors = self._query_vectors(query_embeddings, query_texts)
        return self._nearest(vectors, n_results, where, where_document, include, probes)

    def query(
        self, query_embeddings=None, query_texts=None, n_results=DEFAULT_K, where=None, where_document=None, include=None, probes: int = 0
    ) -> dict:
        vectors = self._query_vectors(query_embeddings, query_texts)
        hits = self._nearest(vectors, n_results, where, where_document, include, probes)
        return results.nested_dict(hits, len(vectors), include)

    def hybrid_frame(self, query=None, knn=None, rank=None, n_results=DEFAULT_K, include=None, probes: int = 0) -> DataFrame:
        """Fused records of both legs. The text leg uses the index where it is up to date."""
        hits = hybrid_search(
            self._scan(),
            query,
            knn,
            rank,
            n_results,
            (),
            self.distance,
            self._embedding_function,
            self._text_index(),
            self._cells(probes) if probes else None,
            **self._options(),
        )
        vectors = (knn or {}).get("query_embeddings")
        many = vectors.count() if isinstance(vectors, DataFrame) else _questions(knn)
        return self._fetch(hits, include, n_results * many)

    def hybrid_search(self, query=None, knn=None, rank=None, n_results=DEFAULT_K, include=None, probes: int = 0) -> dict:
        """Fused results; ``distances`` holds the fused score, or the distance of a vector leg alone."""
        hits = self.hybrid_frame(query, knn, rank, n_results, include, probes)
        measured = hits.withColumn("measure", F.coalesce("score", "distance"))
        return results.nested_dict(measured, _questions(knn), include, "measure")

    # --- indexes ---

    def build_index(self, cells: int = 0, fraction: float = 1.0, seed: int = 7) -> None:
        """Index the current version: its texts, and its vectors in ``cells`` cells.

        After a change the newest index goes on being used: the records of files that changed since are compared, and what left or came is put
        beside the stored postings and cells (see ``operators.deltas``). Build it again once much has changed.
        """
        version = self._version()
        folder = self._index_folder(version)
        if self._store.files.exists(f"{folder}/done.json"):
            return
        self._store.files.delete(folder)
        scan = self._store.read(version)
        write_index(scan, f"{folder}/text")
        if cells:
            centroids = train_cells(scan, cells, self.dimension, self.distance, fraction, seed)
            centroids.write.parquet(f"{folder}/centroids")
            keep = [ID, EMBEDDING, VARIANT, *[typed_column(key) for key in version.typed]]
            write_cells(build_cells(scan.select(*keep), centroids, self.dimension, self.distance), f"{folder}/cells")
        self._store.files.write_new(f"{folder}/done.json", json.dumps({"cells": cells}))

    def _index_folder(self, version: Version) -> str:
        return f"{self._store.folder}/index/{version.number:012d}"

    def _index(self) -> tuple[str, dict, Version] | None:
        """The newest index of this version or an earlier one: its folder, what it holds, and its version."""
        current = self._version()
        for name in reversed(self._store.files.names(f"{self._store.folder}/index")):
            folder = f"{self._store.folder}/index/{name}"
            if int(name) <= current.number and self._store.files.exists(f"{folder}/done.json"):
                version = self._store.version(int(name))
                if version is not None:
                    return folder, json.loads(self._store.files.read(f"{folder}/done.json")), version
        return None

    def _since(self, version: Version, *columns: str) -> tuple[DataFrame, DataFrame] | None:
        """What left and what came since a version; None if it is the current one."""
        current = self._version()
        return None if version.number == current.number else changed_records(*self._store.changes(version, current), columns)

    def _text_index(self) -> TextIndex | None:
        found = self._index()
        if found is None:
            return None
        index, since = read_index(self._store.spark, f"{found[0]}/text"), self._since(found[2], DOCUMENT)
        return index if since is None else text_index_after(index, *since)

    def _cells(self, probes: int) -> CellIndex:
        found = self._index()
        if found is None or not found[1]["cells"]:
            raise ValueError("an approximate search needs build_index(cells=...)")
        read, since = self._store.spark.read, self._since(found[2], EMBEDDING, METADATA)
        cells = CellIndex(read.parquet(f"{found[0]}/cells"), read.parquet(f"{found[0]}/centroids"), probes)
        return cells if since is None else cells_after(cells, *since, self.dimension, self.distance)

    # --- changing ---

    def _prepared(self, batch: DataFrame) -> DataFrame:
        """A batch with vectors for its documents, where the collection has a function to make them."""
        full = conform(batch, keep=tuple(c for c in ("position",) if c in batch.columns))
        if self._embedding_function is not None:
            full = embed_missing(full, self._embedding_function)
        return full

    def _changed(self, batch: DataFrame, judge: bool = True):
        """Stage a batch, refuse bad rows, and tell its size and the buckets it touches."""
        staged, path = self._store.stage(batch)
        try:
            if judge:
                bad = staged.withColumn("reason", fault(self.dimension)).filter("reason is not null").select(ID, "reason").first()
                if bad is not None:
                    raise ValueError(f"record {bad[ID]!r} cannot be stored: {bad['reason']}")
            version = self._version()
            return staged, path, version, staged.count(), self._store.touched(staged, version)
        except Exception:
            self._store.files.delete(path)
            raise

    def _needs_vectors(self, documents, embeddings, metadatas, adding: bool) -> None:
        given = [value is not None and len(value) > 0 for value in (embeddings, documents, metadatas)]
        if given[0]:
            return
        if given[1] and self._embedding_function is None:
            raise ValueError("documents without embeddings need an embedding function")
        if not given[1] and (adding or not given[2]):
            raise ValueError("nothing to store: give embeddings, documents" + ("" if adding else " or metadatas"))

    def add(self, ids, embeddings=None, metadatas=None, documents=None) -> None:
        """Insert records. An id that exists, or comes twice, fails and nothing is inserted."""
        self._needs_vectors(documents, embeddings, metadatas, adding=True)
        self.add_frame(batch_frame(self._store.spark, ids, documents, metadatas, embeddings))

    def add_frame(self, batch: DataFrame) -> None:
        staged, path, version, rows, buckets = self._changed(self._prepared(batch))
        try:
            repeated = mutate.duplicates(self._store.read(version, buckets), staged, bound=rows).first()
            if repeated is not None:
                raise ValueError(f"id {repeated[ID]!r} exists already")
            self._store.append(version, staged)
        finally:
            self._store.files.delete(path)

    def add_valid(self, batch: DataFrame, rejects: str) -> int:
        """Insert what can be inserted and write the other rows with a ``reason`` to ``rejects``."""
        staged, path, version, rows, buckets = self._changed(self._prepared(batch), judge=False)
        try:
            taken = mutate.duplicates(self._store.read(version, buckets), staged, bound=rows).select(ID, F.lit(True).alias("_taken"))
            judged = staged.join(taken, ID, "left").withColumn(
                "reason", F.coalesce(fault(self.dimension), F.when(F.col("_taken"), F.lit("id exists already")))
            )
            bad = judged.filter("reason is not null").drop("_taken")
            bad.write.mode("append").parquet(rejects)
            good = judged.filter("reason is null")
            self._store.append(version, good)
            return good.count()
        finally:
            self._store.files.delete(path)

    def _rewrite(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame, int], DataFrame], **changes) -> None:
        staged, path, version, rows, buckets = self._changed(batch)
        try:
            self._store.rewrite(version, buckets, lambda current: change(current, staged, rows), **changes)
        finally:
            self._store.files.delete(path)

    def update(self, ids, embeddings=None, metadatas=None, documents=None, strict: bool = False) -> None:
        """Replace the given fields. Unknown ids are passed over, or refused if ``strict``."""
        self._needs_vectors(documents, embeddings, metadatas, adding=False)
        self.update_frame(batch_frame(self._store.spark, ids, documents, metadatas, embeddings), strict)

    def update_frame(self, batch: DataFrame, strict: bool = False) -> None:
        def change(current: DataFrame, staged: DataFrame, rows: int) -> DataFrame:
            if strict:
                unknown = mutate.missing(current, staged, bound=rows).first()
                if unknown is not None:
                    raise ValueError(f"id {unknown[ID]!r} does not exist")
            return mutate.update(current, staged)

        self._rewrite(self._prepared(batch), change)

    def upsert(self, ids, embeddings=None, metadatas=None, documents=None) -> None:
        """Update the records that exist, insert the others; of a repeated id, later fields win."""
        self._needs_vectors(documents, embeddings, metadatas, adding=False)
        self.upsert_frame(batch_frame(self._store.spark, ids, documents, metadatas, embeddings))

    def upsert_frame(self, batch: DataFrame, stream: str | None = None, batch_id: int | None = None) -> bool:
        """Upsert a DataFrame. A batch of a stream that was applied before is passed over."""
        changes = {}
        if stream is not None:
            streams = self._version().streams
            if streams.get(stream, -1) >= batch_id:
                return False
            changes["streams"] = {**streams, stream: batch_id}
        self._rewrite(self._prepared(batch), lambda current, staged, rows: mutate.upsert(current, staged, bound=rows), **changes)
        return True

    def replace_sources_frame(self, batch: DataFrame) -> None:
        """Replace all records of the batch's source files by the batch, as one new version."""
        staged, path, version, _, buckets = self._changed(self._prepared(batch))
        try:
            sources = staged.select(source_of(F.col(METADATA)).alias("_source")).filter("_source is not null").distinct()
            held = self._store.read(version).select("bucket", source_of(F.col(METADATA)).alias("_source"))
            doomed = join_small(held, sources, "_source", "left_semi").select("bucket").distinct().collect()  # at most all buckets
            touched = sorted({*buckets, *(row["bucket"] for row in doomed)})
            self._store.rewrite(version, touched, lambda current: mutate.replace_sources(current, staged, source_of))
        finally:
            self._store.files.delete(path)

    def delete(self, ids=None, where=None, where_document=None) -> None:
        """Remove the records that pass all of the given conditions; at least one is needed."""
        if ids is not None and not isinstance(ids, DataFrame):
            ids = [str(i) for i in _listed(ids, (str, int))]
        if ids is None and not where and not where_document:
            raise ValueError("delete needs ids, where or where_document")
        version, options = self._version(), self._options()
        scan = self._store.read(version) if ids is None or isinstance(ids, DataFrame) else self._store.pick(version, ids)
        doomed = mutate.selected_for_delete(scan, ids, where, where_document, **options)
        buckets = [row["bucket"] for row in doomed.select("bucket").distinct().collect()]
        if buckets:
            self._store.rewrite(version, buckets, lambda current: mutate.delete(current, ids, where, where_document, **options))

    def overwrite(self, records: DataFrame) -> None:
        """Replace all records by others, as one new version. An id that comes twice fails and nothing changes."""
        staged, path, version, _, _ = self._changed(self._prepared(records))
        try:
            repeated = staged.groupBy(ID).count().filter("count > 1").first()
            if repeated is not None:
                raise ValueError(f"id {repeated[ID]!r} comes twice")
            self._store.replace_all(version, staged)
        finally:
            self._store.files.delete(path)

    def vacuum(self, keep: int = 2) -> None:
        self._store.vacuum(keep)


class Client:
    """Collections of one database, a folder under ``root``."""

    def __init__(self, spark: SparkSession, root: str, database: str = DEFAULT_DATABASE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.folder = f"{self.root}/{physical_name(database)}"
        self.files = Files(spark, root)
        ship(spark)

    def __enter__(self) -> Client:
        return self

    def __exit__(self, *_) -> None:
        return None

    def _store(self, name: str) -> Store:
        return Store(self.spark, f"{self.folder}/{physical_name(name)}")

    def create_collection(self, name: str, configuration=_UNSET, embedding_function=_UNSET, buckets: int = BUCKETS, typed: dict[str, str] | None = None) -> Collection:
        """Create an empty collection.

        ``buckets`` is how finely a change can be confined; choose it so that a bucket holds a few
        gigabytes. ``typed`` names hot metadata keys (``string``, ``number`` or ``boolean``) that get
        a column of their own, whose statistics let filters skip files.
        """
        if not name:
            raise ValueError("a collection needs a name")
        function = HashingEmbedder() if embedding_function is _UNSET else embedding_function
        settings = resolve_configuration(configuration, function)
        store = self._store(name)
        version = Version(name, settings.dimension, settings.distance, buckets=buckets, typed=dict(typed or {}))
        if store.numbers() or not store.files.write_new(store._log(0), json.dumps(version.__dict__)):
            raise ValueError(f"collection {name!r} exists already")
        return Collection(self, store, version, function)

    def get_collection(self, name: str, embedding_function=_UNSET) -> Collection:
        """Open a collection. Without a function the default one is attached, whatever its dimension."""
        store = self._store(name)
        version = store.version()
        if version is None:
            raise ValueError(f"collection {name!r} does not exist")
        function = HashingEmbedder() if embedding_function is _UNSET else embedding_function
        return Collection(self, store, version, function)

    def get_or_create_collection(self, name: str, configuration=_UNSET, embedding_function=_UNSET, **options) -> Collection:
        """An existing collection wins, and its configuration with it."""
        if self.has_collection(name):
            return self.get_collection(name, embedding_function)
        return self.create_collection(name, configuration, embedding_function, **options)

    def delete_collection(self, name: str) -> None:
        if not self.has_collection(name):
            raise ValueError(f"collection {name!r} does not exist")
        self._store(name).drop()

    def list_collections(self) -> list[Collection]:
        """All collections; one that cannot be read is left out."""
        found = []
        for folder in self.files.names(self.folder):
            if not folder.startswith("c_v1_"):
                continue
            store = Store(self.spark, f"{self.folder}/{folder}")
            try:
                version = store.version()
            except Exception as problem:
                warnings.warn(f"collection in {folder} cannot be read: {problem}", stacklevel=2)
                continue
            if version is not None:
                found.append(Collection(self, store, version, HashingEmbedder()))
        return found

    def has_collection(self, name: str) -> bool:
        return bool(self._store(name).numbers())

    def count_collection(self) -> int:
        return len(self.list_collections())

    def execute(self, sql: str, **parameters) -> DataFrame:
        """Run SQL with Spark; ``Collection.create_view`` makes a collection visible to it."""
        return self.spark.sql(sql, args=parameters or None)


class AdminClient:
    """Databases: the folders under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, root)

    def __enter__(self) -> AdminClient:
        return self

    def __exit__(self, *_) -> None:
        return None

    def _folder(self, name: str) -> str:
        if not name:
            raise ValueError("a database needs a name")
        return f"{self.root}/{physical_name(name)}"

    def create_database(self, name: str) -> None:
        """Create a database if it does not exist."""
        self.files.make_folder(self._folder(name))
        self.files.write_new(f"{self._folder(name)}/database.json", json.dumps({"name": name}))

    def get_database(self, name: str) -> dict:
        if not self.files.exists(f"{self._folder(name)}/database.json"):
            raise ValueError(f"database {name!r} does not exist")
        return {"name": name, "folder": self._folder(name)}

    def delete_database(self, name: str) -> None:
        """Delete a database with its collections; one that does not exist is passed over."""
        self.files.delete(self._folder(name))

    def list_databases(self, limit: int | None = None, offset: int | None = None) -> list[str]:
        """Names in order. An offset counts only together with a limit."""
        found = []
        for folder in self.files.names(self.root):
            path = f"{self.root}/{folder}/database.json"
            if self.files.exists(path):
                found.append(json.loads(self.files.read(path))["name"])
        found.sort()
        return found if limit is None else found[offset or 0 : (offset or 0) + limit]
