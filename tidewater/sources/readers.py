"""Sources: typed table scans, folder discovery, artifacts and score requests.

Reads always carry an explicit schema where one is known; CSV input is typed
with ``try_cast`` after the scan so one bad field turns into NULL instead of
failing the job (the reference's ``errors="coerce"``), and the null tokens
pandas treats as missing are mapped to NULL once, at ingest.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .manifest import current_table, replace_table

# The literals pandas.read_csv reads as missing by default.
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class MissingColumnsError(KeyError):
    pass


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> DataFrame:
    """Fail fast at plan time when required columns are absent (A13); needs no job."""
    there = set(df.columns)
    absent = [c for c in cols if c not in there]
    if absent:
        raise MissingColumnsError(f"{what} lacks {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail fast when input files are absent (A13), via the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    def there(p: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(conf).exists(path)

    absent = sorted(p for p in paths if not there(p))
    if absent:
        raise FileNotFoundError(f"{len(absent)} input path(s) not found: {', '.join(absent)}")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table scan; a column list becomes the scan's ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = PANDAS_NULL_TOKENS,
                        columns: Sequence[str] | None = None) -> DataFrame:
    """Map textual missing markers to SQL NULL in string columns (§1.4)."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lit_tokens = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(lit_tokens), F.lit(None).cast("string")).otherwise(F.col(c))
                           for c in cols})


def read_csv_typed(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    *,
    drop_malformed: bool = False,
    infer: bool = False,
    multi_line: bool = False,
    null_tokens: Sequence[str] = PANDAS_NULL_TOKENS,
) -> DataFrame:
    """CSV scan with header, all columns read as text, then typed with ``try_cast`` (A1, A4).

    ``types`` maps column → Spark SQL type. Unlisted columns stay strings, or with
    ``infer`` take the narrowest of bigint, double and date that all their values
    are (one pass). With ``drop_malformed`` rows with the wrong number of fields are
    dropped, whatever columns a query selects. ``multi_line`` reads quoted newlines
    (and a file then is one task's)."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if drop_malformed:
        # a pruned parse doesn't see a row's width
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", False)
        # DROPMALFORMED needs a schema to know the expected width.
        header = spark.read.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        reader = reader.schema(schema)
    raw = reader.csv(path)
    raw = null_tokens_to_null(raw, null_tokens)
    types = {c: t for c, t in (types or {}).items() if c in raw.columns}
    if infer:
        types = {**inferred_types(raw, [c for c in raw.columns if c not in types]), **types}
    return raw.withColumns({c: _typed(c, t) for c, t in types.items()}) if types else raw


#: Fixed pattern: texts that are read as numbers.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+(\.\d*)?([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)\s*$"


def inferred_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Column → first of bigint, double, date that every non-null text is; columns
    with other texts, or none at all, are left out. One aggregate over the table."""
    if not columns:
        return {}
    kinds = ("bigint", "double", "date")
    tests = {
        "bigint": lambda c: F.col(c).rlike(r"^\s*[+-]?\d+\s*$") & F.col(c).try_cast("bigint").isNotNull(),
        # a pattern first: a cast alone takes 1d and 2f as numbers
        "double": lambda c: F.col(c).rlike(NUMBER_TEXT) & F.col(c).try_cast("double").isNotNull(),
        "date": lambda c: F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$") & F.col(c).try_cast("date").isNotNull(),
    }
    row = df.agg(*[F.min(F.when(F.col(f"`{c}`").isNotNull(), tests[k](f"`{c}`"))).alias(f"{i}_{k}")
                   for i, c in enumerate(columns) for k in kinds]).first()
    found = {c: next((k for k in kinds if row[f"{i}_{k}"]), None) for i, c in enumerate(columns)}
    return {c: k for c, k in found.items() if k}


def _typed(col: str, dtype: str):
    c = F.col(col)
    t = dtype.lower()
    if t in ("date",):
        return F.to_date(F.try_to_timestamp(c))
    if t in ("timestamp", "timestamp_ntz"):
        return F.try_to_timestamp(c).cast(t)
    c = F.when(c.rlike(NUMBER_TEXT), c) if t in ("int", "integer", "bigint", "long", "smallint", "double", "float") else c
    if t in ("int", "integer", "bigint", "long", "smallint"):
        x = c.try_cast("double")
        return F.when(F.isnan(x), None).otherwise(x).try_cast(t)
    if t in ("double", "float"):
        x = c.try_cast("double")
        return F.when(F.isnan(x), None).otherwise(x).cast(t)
    return c.try_cast(t)


def load_table(spark: SparkSession, path: str, out: str, view: str, *, valid=None,
               types: Mapping[str, str] | None = None, infer: bool = True, multi_line: bool = False) -> DataFrame:
    """Load a CSV table (A4, A5): malformed rows dropped, columns typed, the Parquet table
    at ``out`` replaced, and the rows for which ``valid`` (a condition) is true published as
    the temporary view ``view`` (all rows without a condition). Returns the loaded table.

    The table is replaced without a gap (:mod:`manifest`), and its manifest says how many
    rows it has and how many are ``valid``; read it elsewhere with ``current_table``."""
    require_paths(spark, [path])
    df = read_csv_typed(spark, path, types, drop_malformed=True, infer=infer, multi_line=multi_line)
    condition = F.expr(valid) if isinstance(valid, str) else valid
    replace_table(df, out, {} if valid is None else {"valid": condition})
    table = current_table(spark, out)
    (table if valid is None else table.where(condition)).createOrReplaceTempView(view)
    return table


def sample_rows(df: DataFrame, n: int = 5_000) -> DataFrame:
    """Bounded sample scan, the first ``n`` rows in scan order (A2; no order guarantee)."""
    return df.limit(n)


def discover_tables(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Sorted list of table files in a folder (A3), listed through the Hadoop FS."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        raise FileNotFoundError(f"Missing folder: {folder}")
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.endswith(suffix):
            out.append(status.getPath().toString())
    return sorted(out)


def existing_paths(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Paths in ``folder`` whose names begin with ``prefix``, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith(prefix))


def table_name(path: str, suffix: str | None = None) -> str:
    base = os.path.basename(path.rstrip("/"))
    return re.sub(r"\.[A-Za-z0-9]+$", "", base) if suffix is None else base.removesuffix(suffix)


def version_tag(path: str, tags: Sequence[str] = ("v1", "v2", "v3", "v4")) -> str:
    """Dataset tag from a features path: a trailing v1..v4 else ``run``."""
    stem = table_name(path)
    for tag in tags:
        if stem.endswith(tag) or f"version={tag}" in path:
            return tag
    return "run"


def read_artifact(spark: SparkSession, path: str, fmt: str | None = None,
                  schema: T.StructType | str | None = None) -> DataFrame:
    """JSON / JSON-lines / CSV / Parquet artifact with an existence check."""
    require_paths(spark, [path])
    fmt = fmt or path.rsplit(".", 1)[-1].lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt in ("json", "lines"):
        return reader.option("multiLine", fmt == "json").json(path)
    if fmt == "csv":
        return reader.option("header", True).option("inferSchema", schema is None).csv(path)
    return reader.parquet(path)


# Score request fields (A10, H1): the model's per-window totals plus labels.
WINDOW_TOTALS = ["games_played", "minutes_played", "goals", "assists", "yellow_cards", "red_cards"]


def request_schema(windows: Sequence[str] = ("w180", "w365"), position: str = "position",
                   group: str = "player_club_domestic_competition_id") -> T.StructType:
    fields = [T.StructField("request_id", T.StringType()), T.StructField("age", T.DoubleType()),
              T.StructField(position, T.StringType())]
    for w in windows:
        fields += [T.StructField(f"{w}_{m}", T.DoubleType()) for m in WINDOW_TOTALS]
    fields.append(T.StructField(group, T.StringType()))
    return T.StructType(fields)


def read_requests(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Score requests from JSON files (one object per file or JSON lines) (A10)."""
    return spark.read.schema(schema or request_schema()).option("multiLine", True).json(path)


def parse_requests(df: DataFrame, text_col: str, schema: T.StructType | None = None) -> DataFrame:
    """Inline JSON text column → typed request rows (A10)."""
    schema = schema or request_schema()
    return df.select(F.from_json(F.col(text_col), schema).alias("r")).select("r.*")
