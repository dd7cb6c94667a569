"""Shared column helpers of the text operators."""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import new_path

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The runs without ASCII white space; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class Scratch:
    """Written tables of one operator that go once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stage(self, df: DataFrame, label: str, **options: str) -> DataFrame:
        """Write ``df`` into the shared folder, with Parquet options, and go on from the copy."""
        path = new_path(self.spark, label)
        df.write.options(**options).parquet(path)
        copy = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(copy)] = (copy, path)
        return copy

    def drop(self, *copies: DataFrame) -> None:
        """Delete the given tables; what was written from them stays."""
        for copy in copies:
            _, path = self.paths.pop(id(copy))
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A hash of all columns that can be hashed: the last word on the order of rows that tie otherwise."""

    def plain(kind) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(F.lit(seed), *(df[f"`{f.name}`"] for f in df.schema.fields if plain(f.dataType)))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))
