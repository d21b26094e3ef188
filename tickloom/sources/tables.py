"""Reading, shaping, writing and describing the tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import to_decimal
from tickloom.operators import merge
from tickloom.operators.latest import keep_last
from tickloom.schema import TABLES, TableSpec
from tickloom.session import shuffles_removed

#: How rows are stored: most are decimals, small whole numbers to Parquet, which take about 60 % of what Spark's defaults make of them.
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def scan(
    spark: SparkSession, root: str, table: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A stored table with its declared types: no inference, older files read with NULL columns.

    With ``start`` or ``end`` only the folders of those months are read.
    """
    spec = TABLES[table]
    layout = _layout(spark, root, table)
    if layout is None:
        raise FileNotFoundError(f"no table {table} under {root}")
    rows = _read(spark, spec, layout, start and start[:7], end and end[:7])
    if start and spec.by_month:
        rows = rows.where(f"{spec.date_col} >= date'{start}'")
    if end and spec.by_month:
        rows = rows.where(f"{spec.date_col} <= date'{end}'")
    return rows


def write_packed(df: DataFrame, path: str) -> None:
    """The rows in a new folder; what was shuffled for them does not stay on the disks."""
    with shuffles_removed(df.sparkSession):
        df.write.options(**PACKED).parquet(path)


#: Doubles that a projection makes decimals of by whole units; the code for more does not fit a method of the JVM.
UNITS_COLUMNS = 40
_DECIMAL = re.compile(r"decimal\((\d+),([1-9]\d*)\)")


def _strict(name: str, kind: str, given: str = "") -> str:
    """The value in its stored type; one that does not fit fails the job."""
    if given == kind:
        return name
    shape = _DECIMAL.fullmatch(kind) if given == "double" else None
    cast = to_decimal(name, int(shape[1]), int(shape[2])) if shape else f"try_cast({name} AS {kind})"
    problem = f"raise_error(concat('{name}: ', string({name}), ' does not fit {kind}'))"
    # One cast for a value that fits: making a decimal of a double is what storing a wide table costs.
    return f"coalesce({cast}, if({name} IS NULL, NULL, {problem})) AS {name}"


def conform(df: DataFrame, spec: TableSpec | str, extra: Sequence[str] = ()) -> DataFrame:
    """Exactly the table's columns and types, missing ones NULL; ``extra`` columns stay behind them.

    This is where stored scales apply. A value that does not fit its column fails the job;
    :func:`land` sets such rows aside.
    """
    spec = TABLES[spec] if isinstance(spec, str) else spec
    present = dict(df.dtypes)
    doubles = [f.name for f in spec.fields if present.get(f.name) == "double" and _DECIMAL.fullmatch(f.spark_type)]
    if len(doubles) > UNITS_COLUMNS:
        present |= dict.fromkeys(doubles, "")
    return df.selectExpr(
        *(
            _strict(f.name, f.spark_type, present[f.name])
            if f.name in present
            else f"cast(NULL AS {f.spark_type}) AS {f.name}"
            for f in spec.fields
        ),
        *extra,
    )


def _faults(df: DataFrame, spec: TableSpec) -> str:
    """What keeps a row out of the table: columns that do not fit and NULL keys, as one text."""
    kinds = {f.name: f.spark_type for f in spec.fields if f.name in df.columns}
    found = [
        f"if({c} IS NOT NULL AND try_cast({c} AS {kind}) IS NULL, 'overflow {c}', NULL)"
        for c, kind in kinds.items()
    ]
    found += [f"if({c} IS NULL, 'no {c}', NULL)" for c in spec.keys]
    return f"concat_ws(', ', {', '.join(found)})"


@dataclass(frozen=True)
class Landing:
    """Rows written once, to ``folder``: those that can be stored, in the table's shape, those that cannot, and their figures."""

    folder: str
    good: DataFrame
    rejects: DataFrame
    rows: int
    rejected: int
    nulls: Mapping[str, int]


def land(df: DataFrame, spec: TableSpec | str, folder: str) -> Landing:
    """Write ``df`` to ``folder`` in one pass that also sets aside and counts what cannot be stored.

    A row without a key or with a value that does not fit goes to ``rejects`` as it came, with
    ``reject_reason``. A frame that carries a ``reject_reason`` of its own keeps it. The counts (rows,
    rejected rows, NULLs of each column among the others) are observed while the rows are written.
    """
    spec = TABLES[spec] if isinstance(spec, str) else spec
    spark, present = df.sparkSession, set(df.columns)
    own = [c for c in df.columns if c != "reject_reason"]
    given = "coalesce(reject_reason, '')" if "reject_reason" in present else "''"
    reason = f"if({given} != '', {given}, {_faults(df, spec)}) AS _reason"
    checked = df.selectExpr(*(f"{c} AS _raw_{c}" for c in own), reason)
    typed = [
        f"try_cast({'_raw_' + f.name if f.name in own else 'NULL'} AS {f.spark_type}) AS {f.name}" for f in spec.fields
    ]
    raw = ", ".join(f"'{c}', _raw_{c}" for c in own)
    shaped = checked.selectExpr("_reason", *typed, f"if(_reason != '', named_struct({raw}), NULL) AS _landed")
    seen = Observation()
    counts = {"rows": "count(*)", "rejected": "count_if(_reason != '')"}
    counts |= {f"null_{c}": f"count_if(_reason = '' AND {c} IS NULL)" for c in spec.columns}
    write_packed(shaped.observe(seen, *(F.expr(e).alias(n) for n, e in counts.items())), folder)
    stored = spark.read.schema(shaped.schema).parquet(folder)
    figures = seen.get
    return Landing(
        folder,
        stored.where("_reason = ''").select(spec.columns),
        stored.where("_reason != ''").selectExpr("_landed.*", "_reason AS reject_reason"),
        figures["rows"],
        figures["rejected"],
        {c: figures[f"null_{c}"] for c in spec.columns},
    )


def rejects(df: DataFrame, spec: TableSpec | str) -> DataFrame:
    """Rows that cannot be stored, with the reason; all others pass :func:`fitting`."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    return df.selectExpr("*", f"{_faults(df, spec)} AS reject_reason").where("reject_reason != ''")


def fitting(df: DataFrame, spec: TableSpec | str) -> DataFrame:
    """Rows whose keys are known and whose values fit their columns."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    return df.where(f"{_faults(df, spec)} = ''")


def surrogate_id(df: DataFrame, spec: TableSpec | str) -> DataFrame:
    """A stable id from the key columns, equal on every run and every retry."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    return df.selectExpr("*", f"xxhash64({', '.join(spec.keys)}) AS id")


def or_null(df: DataFrame, column: str, kind: str) -> str:
    """The column if the frame has it, else a typed NULL: old schemas stay readable."""
    return column if column in df.columns else f"cast(NULL AS {kind})"


class Store(Mapping[str, DataFrame]):
    """The stored tables that exist, by name, each scanned when asked for.

    ``versions`` are roots of committed versions (derived tables, the update log); a table found in
    the newest version of one of them stands before the raw table of the same name.
    """

    def __init__(self, spark: SparkSession, root: str, versions: Sequence[str] = ()):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = [v.rstrip("/") for v in versions]

    def _versioned(self, table: str) -> str | None:
        for root in self.versions:
            version = latest_version(self.spark, root)
            if version is not None:
                path = table_folder(self.spark, root, version, table)
                if _exists(self.spark, path):
                    return path
        return None

    def __contains__(self, table: object) -> bool:
        if table not in TABLES:
            return False
        stored = _layout(self.spark, self.root, str(table)) is not None
        return stored or self._versioned(str(table)) is not None

    def __getitem__(self, table: str) -> DataFrame:
        return self.between(table, None, None)

    def between(self, table: str, start: str | None, end: str | None) -> DataFrame:
        """The table's rows of a date range, read from those months' folders only."""
        if table not in self:
            raise KeyError(table)
        path = self._versioned(table)
        if path is None:
            return scan(self.spark, self.root, table, start, end)
        rows, day = _visible(self.spark.read.parquet(path)), TABLES[table].date_col
        if start and day:
            rows = rows.where(f"{day} >= date'{start}'")
        return rows.where(f"{day} <= date'{end}'") if end and day else rows

    def __iter__(self) -> Iterator[str]:
        return (t for t in TABLES if t in self)

    def __len__(self) -> int:
        return sum(1 for _ in self)


# --- tables: folders that one marker makes visible ------------------------------------------------
#
# A table's rows lie in folders by month (one folder for tables without a date in their key). Writes go
# to new folders; a manifest, a small text file created last, lists the folders that count. A job that
# dies before that has changed nothing, and of two writers the second to publish fails.

#: Row groups small enough to skip, each with a Bloom filter on the symbol: within a file the rows are sorted, so ranges
#: of symbols tell row groups apart, and the filters tell files apart whose ranges overlap.
SKIPPING = {
    "parquet.block.size": str(16 << 20),
    "parquet.bloom.filter.enabled#stock_code": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
_WHOLE = "all"
_END_LINE = "end"

Layout = Mapping[str, Sequence[str]]


def _manifests(spark: SparkSession, root: str, table: str) -> tuple[int, Layout | None]:
    """The number of the next manifest and the folders by month of the newest complete one."""
    numbers = _numbers(spark, f"{root}/{table}/_manifests")
    for number in numbers:
        lines = _read_text(spark, f"{root}/{table}/_manifests/{number}").split("\n")
        if lines[-1] == _END_LINE:
            layout: dict[str, list[str]] = {}
            for line in lines[:-1]:
                month, folder = line.split("\t")
                layout.setdefault(month, []).append(f"{root}/{table}/{folder}")
            return numbers[0] + 1, layout
    return max(numbers, default=0) + 1, None


def _layout(spark: SparkSession, root: str, table: str) -> Layout | None:
    """The folders by month; of a table without a manifest those that are there; None without a table."""
    _, layout = _manifests(spark, root, table)
    if layout is not None:
        return layout
    base = f"{root}/{table}"
    if not _exists(spark, base):
        return None
    fs, path, _ = _filesystem(spark, base)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    months = {n.removeprefix("month="): [f"{base}/{n}"] for n in names if n.startswith("month=")}
    if months:
        return months
    return {_WHOLE: [base]} if any(not n.startswith("_") for n in names) else None


def _read(
    spark: SparkSession, spec: TableSpec, layout: Layout, first: str | None = None, last: str | None = None
) -> DataFrame:
    folders = [
        f
        for month, paths in sorted(layout.items())
        if month == _WHOLE or (not first or month >= first) and (not last or month <= last)
        for f in paths
    ]
    if not folders:
        return spark.createDataFrame([], spec.struct)
    return spark.read.schema(spec.struct).parquet(*folders)


def _write(shaped: DataFrame, root: str, table: str) -> Layout:
    """Rows in new folders that no reader sees yet.

    The rebalance hint lets adaptive execution split a busy month into tasks and files of the
    advisory size and put quiet months together, whatever the size of the table.
    """
    spec, spark = TABLES[table], shaped.sparkSession
    order: list[str] = list(spec.keys)
    if spec.by_month:
        shaped = shaped.selectExpr("*", f"date_format({spec.date_col}, 'yyyy-MM') AS month")
        shaped, order = shaped.hint("rebalance", "month"), ["month", *order]
    writer = shaped.sortWithinPartitions(*order).write.options(**PACKED)
    if "stock_code" in spec.keys:
        writer = writer.options(**SKIPPING)
    folder = f"_data/{uuid.uuid4().hex}"
    target = f"{root}/{table}/{folder}"
    with shuffles_removed(spark):
        (writer.partitionBy("month") if spec.by_month else writer).parquet(target)
    if not spec.by_month:
        return {_WHOLE: [folder]}
    fs, path, _ = _filesystem(spark, target)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return {n.removeprefix("month="): [f"{folder}/{n}"] for n in names if n.startswith("month=")}


def _publish(spark: SparkSession, root: str, table: str, number: int, layout: Layout) -> None:
    base = f"{root}/{table}/"
    lines = [f"{m}\t{f.removeprefix(base)}" for m, folders in sorted(layout.items()) for f in folders]
    _create_text(spark, f"{base}_manifests/{number}", "\n".join([*lines, _END_LINE]))


def append(df: DataFrame, root: str, table: str) -> None:
    spark = df.sparkSession
    number, _ = _manifests(spark, root, table)
    stored = _layout(spark, root, table) or {}
    added = _write(conform(df, table), root, table)
    months = {*stored, *added}
    _publish(spark, root, table, number, {m: [*stored.get(m, ()), *added.get(m, ())] for m in months})


def export(tables: Mapping[str, DataFrame], root: str, names: Sequence[str]) -> None:
    """Write whole tables as Parquet, sorted within files by their keys so that scans can skip."""
    for name in names:
        frame = tables[name]
        number, _ = _manifests(frame.sparkSession, root, name)
        _publish(frame.sparkSession, root, name, number, _write(conform(frame, name), root, name))


def write_months(df: DataFrame, root: str, table: str) -> None:
    """Replace just the months that occur in ``df``."""
    spark = df.sparkSession
    number, _ = _manifests(spark, root, table)
    stored = _layout(spark, root, table) or {}
    _publish(spark, root, table, number, {**stored, **_write(conform(df, table), root, table)})


def merge_rows(
    spark: SparkSession,
    updates: DataFrame,
    root: str,
    table: str,
    columns: Sequence[str] | None = None,
    rule: merge.Rule = merge.overwrite,
    order: Sequence[str] = (),
) -> None:
    """Upsert into a stored table, rewriting only the months the updates touch.

    Of updates that repeat a key the last by ``order`` (columns of the updates) counts, else the one
    with the greatest values. A NULL key or a value that does not fit fails the job; see
    :func:`land`. Merging the same rows again changes nothing.
    """
    spec = TABLES[table]
    named = [c for c in updates.columns if c in spec.values] if columns is None else columns
    keyed = {k: f"CASE WHEN {k} IS NOT NULL THEN {k} ELSE raise_error('NULL key for {table}') END AS {k}" for k in spec.keys}
    ranks = [f"{c} AS _order{i}" for i, c in enumerate(order)]
    shaped = conform(updates.selectExpr(*(keyed.get(c, c) for c in updates.columns), *ranks), spec, [f"_order{i}" for i in range(len(order))])
    with staging(spark, f"{root}/{table}") as stage:
        merge_landed(spark, stage(shaped), root, table, named, rule)


def merge_landed(
    spark: SparkSession, fresh: DataFrame, root: str, table: str, columns: Sequence[str], rule: merge.Rule = merge.overwrite
) -> None:
    """:func:`merge_rows` of rows that are stored already in the shape of the table.

    Where keys repeat, which the pass that finds the months tells, the last rows are written before they are merged: the
    merge reads them several times, and the optimizer must find plain columns there. It carries a constraint for every expression over all columns
    through every renaming of one of them, which takes it minutes for a wide table.
    """
    spec = TABLES[table]
    number, _ = _manifests(spark, root, table)
    stored = _layout(spark, root, table)
    rank = [c for c in fresh.columns if c.startswith("_order")] or spec.values
    month = f"date_format({spec.date_col}, 'yyyy-MM')" if spec.by_month else f"'{_WHOLE}'"
    by_key = fresh.groupBy(*spec.keys).agg(F.count("*").alias("_rows"))
    found = by_key.selectExpr("max(_rows) > 1 AS repeated", f"collect_set({month}) AS months").first()
    touched = set(found.months) if spec.by_month else {_WHOLE}
    with staging(spark, f"{root}/{table}") as stage:
        updates = fresh.select(spec.columns)
        if found.repeated and rank:
            ranked = fresh.selectExpr(*spec.columns, f"struct({', '.join(rank)}) AS _rank")
            updates = stage(keep_last(ranked, spec.keys, "_rank").select(spec.columns))
        merged = updates
        met = {m: f for m, f in (stored or {}).items() if m in touched}
        if met:  # months that are not stored yet have nothing to be merged with
            merged = merge.upsert(_read(spark, spec, met), updates, spec.keys, columns, rule)
        if touched:
            added = _write(merged, root, table)
            _publish(spark, root, table, number, {**(stored or {}), **added})


def vacuum(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete folders that no manifest row names any more; for times without writers."""
    _, layout = _manifests(spark, root, table)
    if layout is None:
        return []
    kept = {f.removeprefix(f"{root}/{table}/_data/").split("/")[0] for fs in layout.values() for f in fs}
    fs, path, jvm = _filesystem(spark, f"{root}/{table}/_data")
    gone = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName() not in kept]
    for folder in gone:
        fs.delete(folder, True)
    return [g.getName() for g in gone]


# --- versions: data and watermark become visible together ---------------------------------------


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target, _ = _filesystem(spark, path)
    return fs.exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    """A folder that this job made for itself."""
    fs, target, _ = _filesystem(spark, path)
    fs.delete(target, True)


@contextmanager
def staging(spark: SparkSession, root: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives frames back as written ones, for those that several outputs are made of; they go at the end."""
    folder = f"{root}/_staging/{uuid.uuid4().hex}"

    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        write_packed(df, path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        _remove(spark, folder)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, target, _ = _filesystem(spark, path)
    return fs.getFileStatus(target).isFile()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target, jvm = _filesystem(spark, path)
    stream = fs.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; fails if another writer has created it."""
    fs, target, _ = _filesystem(spark, path)
    if fs.exists(target):
        raise RuntimeError(f"{path} was published by another writer")
    stream = fs.create(target, False)  # the file system refuses the second of two
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the markers in a folder, newest first."""
    fs, target, _ = _filesystem(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest committed version under ``root``; a marker whose writer died while writing is none."""
    numbers = _numbers(spark, f"{root}/_commits")
    return next((n for n in numbers if _read_text(spark, f"{root}/_commits/{n}").endswith("\n")), None)


def table_folder(spark: SparkSession, root: str, version: int, name: str) -> str:
    """Where a version's rows of a table are: in the folder that its marker names, or in that of an earlier version."""
    folder, *lines = _read_text(spark, f"{root}/_commits/{version}").strip().split("\n")
    kept = dict(line.split("\t") for line in lines)
    return f"{root}/{kept.get(name, f'{folder}/{name}')}"


def _visible(df: DataFrame) -> DataFrame:
    """Without the columns, named with an underscore, that are there for a table made from this one."""
    return df.select([c for c in df.columns if not c.startswith("_")])


def commit_version(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | Callable[[str], DataFrame]],
    root: str,
    kept: tuple[int, Sequence[str]] = (0, ()),
) -> int:
    """Write frames as one new version; readers see all of them or none.

    A function is given the version's folder and makes its frame from the tables written before it. ``kept`` are an
    earlier version and those of its tables that this one has too: their files are not written again.
    Every attempt writes to a folder of its own, which the marker, created last, names. A job that
    dies before that leaves an invisible folder; of two writers the second fails.
    """
    version = max(_numbers(spark, f"{root}/_commits"), default=0) + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    for name, frame in frames.items():
        rows = frame if isinstance(frame, DataFrame) else frame(f"{root}/{folder}")
        write_packed(rows, f"{root}/{folder}/{name}")
    earlier, names = kept
    lines = [f"{n}\t{table_folder(spark, root, earlier, n).removeprefix(f'{root}/')}" for n in names]
    _create_text(spark, f"{root}/_commits/{version}", "\n".join([folder, *lines]) + "\n")
    return version


def has_table(spark: SparkSession, root: str, name: str, version: int) -> bool:
    return _exists(spark, table_folder(spark, root, version, name))


def read_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    chosen = latest_version(spark, root) if version is None else version
    if chosen is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return _visible(spark.read.parquet(table_folder(spark, root, chosen, name)))


# --- dictionary and catalog -------------------------------------------------------------------


def column_dictionary(spark: SparkSession) -> DataFrame:
    """Description and unit of every column, from the table declarations."""
    rows = [
        (spec.name, f.name, f.description, f.unit) for spec in TABLES.values() for f in spec.fields
    ]
    return spark.createDataFrame(rows, TABLES["column_metadata"].struct)


def list_columns(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    return [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]


def table_profile(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Rows, symbols and date range of each table: one aggregate per table."""
    report = None
    for table in names:
        frame, day = tables[table], TABLES[table].date_col or "date(NULL)"
        keyed = "stock_code" in frame.columns
        symbols = "count(DISTINCT stock_code)" if keyed else "bigint(NULL)"
        part = frame.selectExpr(
            "count(*) AS rows",
            f"{symbols} AS symbols",
            f"min({day}) AS first_date",
            f"max({day}) AS last_date",
        ).selectExpr(f"'{table}' AS table_name", "*")
        report = part if report is None else report.unionByName(part)
    return report
