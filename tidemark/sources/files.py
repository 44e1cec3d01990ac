"""Files as rows: manifests by content, the file in force, replay order, guarded delimited scans, bundle ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stored import saved

#: Bytes of the largest file whose content is read into a row to be hashed.
LARGEST = 256 << 20


def manifest(spark: SparkSession, registry: DataFrame, pattern: str, name: str = r"([^/]+)$", largest: int = LARGEST) -> DataFrame:
    """Registered files (source_id, file_name) found under a path, with content hash, vintage and time.

    ``name`` extracts from a path what the registry calls a file. Files of more than ``largest`` bytes are listed without a hash and
    without their content being read; state tells, and it is so for registered files that aren't there.
    """
    found = spark.read.format("binaryFile").load(pattern)
    about = [F.col(c) for c in ("path", "modificationTime", "length")]
    small = found.filter(F.col("length") <= largest).select(*about, F.sha2("content", 256).alias("sha256"))
    large = found.filter(F.col("length") > largest).select(*about, F.lit(None).cast("string").alias("sha256"))
    named = small.unionByName(large).withColumn("file_name", F.regexp_extract("path", name, 1))
    both = named.join(F.broadcast(registry), "file_name", "right")
    state = F.when(F.col("path").isNull(), "missing").when(F.col("sha256").isNull(), "too large").otherwise("found")
    return both.withColumn("state", state).withColumn("vintage_id", F.when(F.col("sha256").isNotNull(), F.concat_ws(":", "source_id", F.substring("sha256", 1, 24))))


def in_force(files: DataFrame, recorded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One file for each source: that of the recorded hash, else the newest; and sources with a tie as issues."""
    known = files.join(F.broadcast(recorded.select("source_id", F.col("sha256").alias("_sha"))), "source_id", "left").withColumn("_hit", F.coalesce(F.col("_sha") == F.col("sha256"), F.lit(False)))
    order = Window.partitionBy("source_id").orderBy(F.col("_hit").desc(), F.col("modificationTime").desc(), "sha256")
    ranked = known.withColumn("_k", F.rank().over(Window.partitionBy("source_id").orderBy(F.col("_hit").desc(), F.col("modificationTime").desc()))).withColumn("_n", F.row_number().over(order))
    top = ranked.filter("_k = 1")
    tied = top.groupBy("source_id").agg(F.countDistinct("sha256").alias("candidates")).filter("candidates > 1")
    chosen = top.filter("_n = 1").join(tied, "source_id", "left_anti").drop("_sha", "_hit", "_k", "_n")
    return chosen, tied


def replay_order(archive: DataFrame) -> DataFrame:
    """Each content once, by publication date with unknown dates last, then by time."""
    once = archive.withColumn("_k", F.row_number().over(Window.partitionBy("source_id", "sha256").orderBy("modificationTime", "path"))).filter("_k = 1").drop("_k")
    return once.orderBy(F.col("publication_date").asc_nulls_last(), "modificationTime", "source_id")


def replay_places(archive: DataFrame) -> DataFrame:
    """The place of each content in its source's replay, from 1."""
    once = archive.withColumn("_k", F.row_number().over(Window.partitionBy("source_id", "sha256").orderBy("modificationTime", "path"))).filter("_k = 1").drop("_k")
    return once.withColumn("place", F.row_number().over(Window.partitionBy("source_id").orderBy(F.col("publication_date").asc_nulls_last(), "modificationTime", "sha256")))


def bundle_id(files: DataFrame) -> DataFrame:
    """One hash of the sorted source:hash keys; a registry's worth of rows."""
    key = F.concat_ws(":", "source_id", "sha256")
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(key)), "|"), 256).alias("bundle_id"), F.count("*").alias("n_files"))


def guarded(spark: SparkSession, path: str, header: list[str], sep: str = ";") -> DataFrame:
    """Delimited files as trimmed text columns with the file and the row in it, counted from 1 below the header.

    A header that differs (a byte-order mark and blanks aside) or a malformed line refuses everything. Rows are numbered by their
    distance from the first row of their split of a file, which starts at its number of earlier rows: rows are neither moved nor sorted.
    """
    found = [c.strip("\ufeff ") for c in spark.read.option("sep", sep).option("header", True).csv(path).columns]
    if found != header:
        raise ValueError(f"the header is {found}, not {header}")
    schema = ", ".join(f"`{c}` string" for c in header)
    rows = spark.read.schema(schema).option("sep", sep).option("header", True).option("mode", "FAILFAST").csv(path)
    # A split is read by one task in its order, so its ids follow each other; they are written, so both uses see the same.
    placed = saved(rows.select(*(F.trim(c).alias(c) for c in header), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id")), "guarded-rows")
    sizes = placed.groupBy("source_file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("source_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("source_file", "_start", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return placed.join(F.broadcast(before), ["source_file", "_start"]).select(*header, "source_file", (F.col("_id") + F.col("_shift")).alias("source_row"))


def counted_places(rows: DataFrame, *by: str) -> DataFrame:
    """(by, n_places): distinct (source_file, source_row) of each group, exactly, as set bits of words of 64 neighbouring rows."""
    word, bit = F.shiftright("source_row", 6), F.expr("shiftleft(1L, cast(source_row & 63 as int))")
    words = rows.groupBy(*by, "source_file", word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy(*by).agg(F.sum(F.bit_count("_bits")).cast("long").alias("n_places"))


def direct_panel(rows: DataFrame, header: list[str], codes: list[str], **lineage: str) -> DataFrame:
    """A panel whose columns are those of the header in any order, its codes as text (whole numbers without decimals)
    and its lineage beside it. Any other column set refuses the panel."""
    if sorted(rows.columns) != sorted(header):
        raise ValueError(f"the columns are {rows.columns}, not {header}")
    whole = lambda c: F.coalesce(F.when(F.col(c).try_cast("double") == F.floor(F.col(c).try_cast("double")), F.col(c).try_cast("double").cast("long").cast("string")), F.col(c).cast("string"))
    return rows.select(*(whole(c).alias(c) if c in codes else F.col(c) for c in header), *(F.lit(v).alias(k) for k, v in lineage.items()))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Recorded files, typed; a value that is not of its type refuses the register."""
    return spark.read.schema("source_id string, sha256 string, publication_date date").option("header", True).option("mode", "FAILFAST").csv(path)


def extent(rows: DataFrame) -> DataFrame:
    """Rows and columns."""
    return rows.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(rows.columns)))


def date_from_name(name):
    """The last day of the month that a file name ends on, as yyyy-mm or yyyymm."""
    y, m = F.regexp_extract(name, r"((?:19|20)[0-9]{2})[-_]?(0[1-9]|1[0-2])", 1), F.regexp_extract(name, r"((?:19|20)[0-9]{2})[-_]?(0[1-9]|1[0-2])", 2)
    return F.last_day(F.make_date(y.try_cast("int"), m.try_cast("int"), F.lit(1)))


def long_form(wide: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Wide rows as (keys, column, text, num, date)."""
    long = wide.select(*keys, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot(keys, columns, "column", "text")
    return long.withColumn("num", F.col("text").try_cast("double")).withColumn("date", F.try_to_date("text", "yyyy-MM-dd"))
