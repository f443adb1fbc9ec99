"""Collections kept as Parquet, changed by writing new files and switching to a new version.

``<root>/<database>/<collection>/log/<n>.json`` is version n: the properties, and for every hash
bucket of ``_id`` the folders that hold it. ``data/v=<name>/bucket=<b>/`` holds records. A change
rewrites only the buckets it touches, in a folder of its own, and then creates the next log file;
that is one atomic step, so readers see all of a change or nothing, and of two writers one fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hybridframe.schema import FIELDS, ID, METADATA, RECORD, conform
from hybridframe.sources.files import Files

BUCKETS = 64
VARIANT = "_metadata_variant"
TYPED = {"string": "string", "number": "double", "boolean": "boolean"}


class ChangeConflict(RuntimeError):
    """Another writer changed the collection first; nothing was changed by this one."""


@dataclass(frozen=True)
class Version:
    """Properties of a collection and the folders of its buckets, at one version."""

    name: str
    dimension: int
    distance: str
    number: int = 0
    buckets: int = BUCKETS
    typed: dict[str, str] = field(default_factory=dict)
    folders: dict[str, list[str]] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


def physical_name(name: str) -> str:
    """A folder and table name for any collection name; different names stay different."""
    escaped = re.sub(r"[^A-Za-z0-9]", lambda m: "__" if m.group() == "_" else f"_{ord(m.group()):x}_", name)
    return f"c_v1_{escaped}"


def typed_column(key: str) -> str:
    return f"_typed_{physical_name(key)}"


class Store:
    """The folder of one collection."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.files = Files(spark, folder)

    # --- versions ---

    def numbers(self) -> list[int]:
        names = self.files.names(f"{self.folder}/log")
        return sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d+\.json", name))

    def version(self, number: int | None = None) -> Version | None:
        """A version, the newest by default; None where the collection does not exist."""
        numbers = self.numbers()
        if not numbers or (number is not None and number not in numbers):
            return None
        return Version(**json.loads(self.files.read(self._log(numbers[-1] if number is None else number))))

    def commit(self, version: Version) -> Version:
        if not self.files.write_new(self._log(version.number), json.dumps(asdict(version))):
            raise ChangeConflict(f"version {version.number} of {version.name!r} exists already")
        return version

    def drop(self) -> None:
        self.files.delete(self.folder)

    def vacuum(self, keep: int = 2) -> None:
        """Forget all but the newest versions and delete the folders that none of them uses."""
        numbers = self.numbers()
        used = {v for n in numbers[-keep:] for folders in self.version(n).folders.values() for v in folders}
        for number in numbers[:-keep]:
            self.files.delete(self._log(number))
        for name in self.files.names(f"{self.folder}/index"):
            if int(name) not in numbers[-keep:]:
                self.files.delete(f"{self.folder}/index/{name}")
        for name in self.files.names(f"{self.folder}/data"):
            if name.removeprefix("v=") not in used:
                self.files.delete(f"{self.folder}/data/{name}")

    def _log(self, number: int) -> str:
        return f"{self.folder}/log/{number:012d}.json"

    # --- reading ---

    def schema(self, version: Version) -> T.StructType:
        schema = T.StructType(list(RECORD.fields)).add(VARIANT, T.VariantType())
        for key, family in version.typed.items():
            schema = schema.add(typed_column(key), TYPED[family])
        return schema.add("v", "string").add("bucket", "integer")

    def read(self, version: Version, buckets: list[int] | None = None) -> DataFrame:
        """Records with the columns that help filters; only the folders of ``buckets`` if given."""
        wanted = version.folders if buckets is None else {str(b): version.folders.get(str(b), []) for b in buckets}
        paths = [f"{self.folder}/data/v={v}/bucket={b}" for b, folders in wanted.items() for v in folders]
        schema = self.schema(version)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/data").parquet(*paths)

    def changes(self, old: Version, new: Version) -> tuple[DataFrame, DataFrame]:
        """The records of the folders that only one of two versions has, for each: all that differs between them is in there."""

        def only(one: Version, other: Version) -> DataFrame:
            own = {b: [v for v in folders if v not in other.folders.get(b, [])] for b, folders in one.folders.items()}
            return self.read(replace(one, folders={b: folders for b, folders in own.items() if folders}))

        return only(old, new), only(new, old)

    @staticmethod
    def bucket_of(ident: Column, version: Version) -> Column:
        return F.pmod(F.xxhash64(ident), F.lit(version.buckets)).cast("int")

    def pick(self, version: Version, ids: list[str]) -> DataFrame:
        """Records of a short list of ids. Only their buckets are read, and there only the row groups
        whose id range fits, since files are sorted by id."""
        if not ids:
            return self.read(version, [])
        wanted = self.spark.createDataFrame([(i,) for i in ids], f"{ID} string")
        return self.read(version, self.touched(wanted, version)).filter(F.col(ID).isin(ids))

    # --- changing ---

    def touched(self, frame: DataFrame, version: Version) -> list[int]:
        """The buckets that hold the ids of a frame; never more than there are buckets."""
        rows = frame.select(self.bucket_of(F.col(ID), version).alias("bucket")).distinct().collect()
        return sorted(row["bucket"] for row in rows)

    def write(self, records: DataFrame, version: Version) -> tuple[str, list[int]]:
        """Write records into a new folder, one subfolder per bucket; the folder and its buckets."""
        name = uuid.uuid4().hex
        rows = conform(records).withColumn(VARIANT, F.try_parse_json(METADATA))
        for key, family in version.typed.items():
            rows = rows.withColumn(typed_column(key), _typed(key, family))
        rows = rows.withColumn("bucket", self.bucket_of(F.col(ID), version))
        path = f"{self.folder}/data/v={name}"
        # Rebalancing cuts a bucket into files of similar size, and several small ones share a task.
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", ID).write.partitionBy("bucket").parquet(path)
        return name, [int(n.removeprefix("bucket=")) for n in self.files.names(path) if n.startswith("bucket=")]

    def append(self, version: Version, records: DataFrame, **changes) -> Version:
        """New records beside the old ones."""
        name, buckets = self.write(records, version)
        folders = {b: list(v) for b, v in version.folders.items()}
        for bucket in buckets:
            folders.setdefault(str(bucket), []).append(name)
        return self.commit(replace(version, number=version.number + 1, folders=folders, **changes))

    def rewrite(self, version: Version, buckets: list[int], change: Callable[[DataFrame], DataFrame], **changes) -> Version:
        """Replace the given buckets by what ``change`` makes of their records."""
        current = self.read(version, buckets).select(*FIELDS, VARIANT, *[typed_column(key) for key in version.typed])
        name, kept = self.write(change(current), version)
        folders = {b: v for b, v in version.folders.items() if int(b) not in set(buckets)}
        folders.update({str(bucket): [name] for bucket in kept})
        return self.commit(replace(version, number=version.number + 1, folders=folders, **changes))

    def replace_all(self, version: Version, records: DataFrame, **changes) -> Version:
        name, buckets = self.write(records, version)
        folders = {str(bucket): [name] for bucket in buckets}
        return self.commit(replace(version, number=version.number + 1, folders=folders, **changes))

    def stage(self, batch: DataFrame) -> tuple[DataFrame, str]:
        """A batch as a written table: read several times, it must be the same each time."""
        path = f"{self.folder}/staging/{uuid.uuid4().hex}"
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path), path


def _typed(key: str, family: str) -> Column:
    """A copy of a metadata key where its value is of the declared family, else NULL."""
    from hybridframe.functions.predicates import variant_path

    value = F.try_variant_get(VARIANT, variant_path(key), "variant")
    kind = F.schema_of_variant(value)
    if family == "number":
        fits = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    else:
        fits = kind == family.upper()
    return F.when(fits, F.try_variant_get(value, "$", TYPED[family]))
