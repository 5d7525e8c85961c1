"""Sources (S1-S6): pairs CSV, line-aligned bitext, documents, glossary,
translation memory JSON, run-metrics CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_space, strip_ws
from ..operators.bleu import zip_lines
from ..operators.memory import newest_entries
from ..operators.runs import RUNS_SCHEMA

_BOM = "\ufeff"


def _csv(spark: SparkSession, path: str, header: bool = True, multi_line: bool = False):
    # RFC-4180 style: doubled quotes inside quoted cells. Cells that span lines
    # need ``multi_line``, which makes each file one task.
    return (spark.read.option("header", header).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
            .option("inferSchema", False).csv(path))


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _file_order(df: DataFrame) -> DataFrame:
    """``df`` with ``line_no``: the position of each row over all files of the
    input in name order (0-based), ``_file_start``: it is its file's first row, and ``_file``.

    Rows keep their order inside a file split and every split knows its byte
    offset (``_metadata.file_block_start``). Rows are counted per split (one small
    aggregate); a split's offset is the running count over the splits in (file
    name, offset) order, one row per split. A row's number is its split's offset
    plus its index within the split, however splits are packed into tasks.
    """
    base = (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_block", F.col("_metadata.file_block_start"))
              .withColumn("_mid", F.monotonically_increasing_id()))
    blocks = base.groupBy("_file", "_block").agg(F.min("_mid").alias("_first"),
                                                 F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_file").orderBy("_block")
    blocks = blocks.withColumns({"_off": F.coalesce(F.sum("_n").over(before), F.lit(0)),
                                 "_head": F.row_number().over(in_file) == 1})
    out = base.join(blocks.select("_file", "_block", "_first", "_off", "_head"), ["_file", "_block"])
    index = F.col("_mid") - F.col("_first")
    return out.withColumns({"line_no": (F.col("_off") + index).cast("long"),
                            "_file_start": F.col("_head") & (index == 0)}).drop(
        "_block", "_mid", "_first", "_off", "_head")


def read_pairs_csv(spark: SparkSession, path: str, source_col: str = "source",
                   target_col: str = "target", normalize: bool = False, multi_line: bool = False) -> DataFrame:
    """``(line_no, source, target)`` from a header CSV.

    BOM-safe, doubled-quote escaping; ``multi_line`` allows cells that span lines
    (one task per file). Rows are numbered in (file name, position) order. A missing
    column fails before any job. Short rows give NULL cells (treated as ``""``
    downstream). ``normalize=True`` whitespace-normalises both sides and
    drops rows with an empty side (the preprocessing loader).
    """
    raw = _csv(spark, path, multi_line=multi_line)
    names = {c.lstrip(_BOM): c for c in raw.columns}
    absent = [c for c in (source_col, target_col) if c not in names]
    if absent:
        raise ValueError(f"no column {absent} in the CSV header {list(names)}")
    df = _file_order(raw).select("line_no", F.col(f"`{names[source_col]}`").alias("source"),
                                 F.col(f"`{names[target_col]}`").alias("target"))
    if normalize:
        df = df.withColumns({"source": normalize_space("source"), "target": normalize_space("target")})
        df = df.filter((F.col("source") != "") & (F.col("target") != ""))
    return df


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """``(line_no, line)`` of a text file, or of the parts of a folder in name
    order; a BOM at the start of a file is removed. Lines end with LF, CR or CRLF
    unless ``line_sep`` says otherwise."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    line = F.when(F.col("_file_start"), F.regexp_replace("value", "^" + _BOM, "")).otherwise(F.col("value"))
    return _file_order(reader.text(path)).select("line_no", line.alias("line"))


def read_bitext(spark: SparkSession, src_path: str, tgt_path: str) -> DataFrame:
    """Line-aligned parallel files or folders -> ``(line_no, source, target)``.

    Line i of one side pairs with line i of the other (equi-join on the line
    number); unequal line counts fail the job, whatever columns are asked for.
    """
    s = read_lines(spark, src_path).withColumnRenamed("line", "source")
    t = read_lines(spark, tgt_path).withColumnRenamed("line", "target")
    return zip_lines(s, t, "line_no").select("line_no", "source", "target")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(doc_id = path, text)``, stripped, BOM removed (S3)."""
    df = spark.read.text(path, wholetext=True)
    text = strip_ws(F.regexp_replace("value", "^" + _BOM, ""))
    return df.select(F.col("_metadata.file_path").alias("doc_id"), text.alias("text"))


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """``(ord, source_term, target_term)``: header skipped, first two columns,
    file order in ``ord`` (S4). Trimming and the duplicate rule are applied by
    ``operators.glossary.normalize_glossary``."""
    raw = _csv(spark, path)
    if len(raw.columns) < 2:
        return spark.createDataFrame([], "ord long, source_term string, target_term string")
    c0, c1 = raw.columns[:2]
    return _file_order(raw).select(
        F.col("line_no").alias("ord"), F.col(f"`{c0}`").alias("source_term"), F.col(f"`{c1}`").alias("target_term"))


_ENTRY_MAP = T.MapType(T.StringType(), T.StringType())


def read_memory_json(spark: SparkSession, path: str) -> DataFrame:
    """``(source, translation)`` from one JSON object per file.

    Missing file, bad JSON or a non-object give no rows. JSON ``null``
    becomes NULL (still a hit: presence of the key counts). A repeated key keeps
    its last value (over files: of the last file by name).

    A file with one entry per line (``{`` and ``}`` on lines of their own, as indented
    JSON is written) is read by lines, so that many tasks share it whatever its
    size; its layout is checked first. Any other file is one cell.
    """
    schema = "source string, translation string"
    if not _path_exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = _file_order(spark.read.option("lineSep", "\n").text(path))
    line = F.when(F.col("_file_start"), F.regexp_replace("value", "^" + _BOM, "")).otherwise(F.col("value"))
    lines = lines.select("_file", "line_no", F.trim(F.regexp_replace(line, "\r$", "")).alias("line"))
    lines = lines.withColumns({
        "comma": F.endswith("line", F.lit(",")),
        "entry": F.map_entries(F.from_json(F.concat(F.lit("{"), F.regexp_replace("line", ",$", ""), F.lit("}")),
                                           _ENTRY_MAP))})
    opens, closes, entry = F.col("line") == "{", F.col("line") == "}", F.size("entry") == 1
    at = F.col("line_no")
    layout = lines.groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"),
        F.count_if(entry & F.col("comma")).alias("with_comma"),
        *[F.count_if(c).alias(k) for k, c in (("opening", opens), ("closing", closes), ("entries", entry))],
        F.min(F.when(opens, at)).alias("opened"), F.max(F.when(closes, at)).alias("closed"),
        F.max(F.when(entry & ~F.col("comma"), at)).alias("plain"))
    by_lines = layout.where(
        "opening = 1 AND closing = 1 AND opened = first AND closed = last AND n = entries + 2 AND entries > 0 "
        "AND with_comma = entries - 1 AND plain = last - 1")
    whole = [r[0] for r in layout.join(by_lines, "_file", "left_anti").select("_file").collect()]
    found = lines.join(by_lines.select("_file"), "_file", "left_semi").where(entry).select(
        "_file", at.alias("_at"), F.explode("entry").alias("_e"))
    if whole:
        cells = spark.read.text(whole, wholetext=True).select("value", F.col("_metadata.file_path").alias("_file"))
        cell = F.map_entries(F.from_json(F.regexp_replace("value", "^" + _BOM, ""), _ENTRY_MAP))
        found = found.unionByName(cells.select("_file", F.posexplode(cell).alias("_at", "_e")))
    return found.groupBy(F.col("_e.key").alias("source")).agg(
        F.max_by("_e.value", F.struct("_file", "_at")).alias("translation"))


def read_memory(spark: SparkSession, base: str) -> DataFrame:
    """``(source, translation)`` of all snapshots below ``base`` (``write_memory``): the
    newest snapshot that holds a key decides. No snapshot gives no rows."""
    if not _path_exists(spark, base):
        return spark.createDataFrame([], "source string, translation string")
    rows = spark.read.schema("source string, translation string, snapshot string, bucket int").parquet(base)
    return newest_entries(rows)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(token, count, rank)`` of the lines that ``write_vocab`` wrote (K3)."""
    parts = F.split("line", "\t")
    return read_lines(spark, path).select(parts[0].alias("token"), parts[1].cast("long").alias("count"),
                                          (F.col("line_no") + 1).alias("rank"))


def read_translations(spark: SparkSession, path: str, col: str = "translation") -> DataFrame:
    """``(doc_id, pos, <col>)``: the lines of ``write_translations(fmt="text")`` with the
    document they belong to, by its manifest. A document without lines has none."""
    manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest")
    last = F.col("first_line") + F.col("lines") - 1
    owners = manifest.where("lines > 0").select("doc_id", F.posexplode(F.sequence("first_line", last)).alias("pos", "line_no"))
    # One row per line: sized by its small files, the planner would send it whole through the driver.
    return owners.hint("merge").join(read_lines(spark, f"{path.rstrip('/')}/lines", "\n"), "line_no").select(
        "doc_id", "pos", F.col("line").alias(col))


def read_runs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Run-metrics CSV with a typed schema and ``row_no`` in file order (S6);
    a missing file gives an empty table."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], RUNS_SCHEMA + ", row_no long")
    df = (spark.read.schema(RUNS_SCHEMA).option("header", True).option("encoding", "UTF-8")
          .option("quote", '"').option("escape", '"').csv(path))
    columns = df.columns
    return _file_order(df).select(*columns, F.col("line_no").alias("row_no"))
