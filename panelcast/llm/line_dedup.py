"""Line deduplication on levelled sorted runs of line hashes."""

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import SPACES, lower_ascii
from panelcast.session import new_path, stage


def lines(text: Column) -> Column:
    """The text split at ``\\n``; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column, least: int) -> Column:
    """md5 of the stripped line in lower case; null for lines under ``least`` code points."""
    key = lower_ascii(F.trim(line, F.lit(SPACES)))
    return F.when(F.length(key) >= least, F.md5(key))


class LineRuns:
    """Sorted runs of ``(key, n, last)``: in how many documents a line stands, and the largest id of these.

    A run is a table bucketed and sorted by key, so batches and runs meet in merge joins that move the
    batch alone, and runs merge without any exchange. A new batch first leaves out the keys that a run
    already holds as decided (``n >= min_docs``): batches come with falling ids, so nothing later can
    change the verdict on such a key. What is left becomes a run of level 0; ``fanout`` runs of one level
    are merged into one of the next. Keys are unique within a run, so a line in a third of all documents
    is one row here.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key").format("parquet").option(
            "path", new_path(self.spark, f"line-run-{level}")
        ).saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        def merge(left: DataFrame, right: DataFrame) -> DataFrame:
            l, r = left.alias("l"), right.alias("r")
            n = F.coalesce(F.col("l.n"), F.lit(0)) + F.coalesce(F.col("r.n"), F.lit(0))
            return l.hint("merge").join(r, F.col("l.key") == F.col("r.key"), "full").select(
                F.coalesce("l.key", "r.key").alias("key"), n.alias("n"), F.greatest("l.last", "r.last").alias("last")
            )

        return functools.reduce(merge, [self.spark.table(x) for x in names])

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``(key, doc_id)``, one row per document and key."""
        rows = batch.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        for name in self.runs():
            decided = self.spark.table(name).filter(F.col("n") >= self.min_docs).select("key")
            rows = rows.join(decided.hint("merge"), "key", "left_anti")
        self._push(self._write(rows, 0), 0)

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level, self.levels[level])

    def _compact(self, level: int, names: list[str]) -> None:
        merged = self._write(self._merged(names), level + 1)
        self.levels[level] = []
        self._forget(names)
        self._push(merged, level + 1)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry only: the files belong to the shared folder

    def repeated(self) -> DataFrame:
        """``(key, last)`` of the lines in ``min_docs`` documents or more, from all runs."""
        if not self.runs():
            return self.spark.createDataFrame([], "key string, last long")
        found = stage(self._merged(self.runs()).filter(F.col("n") >= self.min_docs).select("key", "last"), "lines")
        self._forget(self.runs())
        return found


def drop_repeated_lines(
    docs: DataFrame, least: int = 20, min_docs: int = 3, batches: int = 4, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    A line whose key stands in ``min_docs`` documents or more stays only in the one with the largest id.
    Batches are ranges of ids, the largest first; every batch covers its whole texts. The line hashes are
    written once; texts move only in the last join, where each document meets the positions of its own
    dropped lines, and what is kept are the slices between these positions: linear in the lines of a
    document, however long.

    Each row is a document; rows that share an id keep or lose a line together. Null ids are below all
    others: their lines go where another document or none holds the largest id (all null: all stay). A
    null or empty text is one empty line; lines under ``least`` code points always stay. An empty table
    gives no rows; input columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("th"),
        F.transform(lines(F.col(text)), lambda line: line_key(line, least)).alias("keys"),
    ).filter(F.exists("keys", lambda k: k.isNotNull()))
    keyed = stage(keyed, "line-keys")
    cuts = sorted(keyed.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)) if batches > 1 else []
    bounds = [None, *reversed(cuts), None]
    runs = LineRuns(spark, min_docs)
    for above, below in zip(bounds[1:], bounds[:-1]):
        batch = keyed
        if below is not None:
            batch = batch.filter((F.col("doc_id") < below) | F.col("doc_id").isNull() if above is None else F.col("doc_id") < below)
        if above is not None:
            batch = batch.filter(F.col("doc_id") >= above)
        each = batch.select("doc_id", F.explode(F.array_distinct("keys")).alias("key")).filter("key IS NOT NULL")
        runs.add(each)
    lost = (
        keyed.select("doc_id", "th", F.posexplode("keys").alias("at", "key"))
        .filter("key IS NOT NULL")
        .join(runs.repeated(), "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy("doc_id", "th")
        .agg(F.sort_array(F.collect_set("at")).alias("__lost"))
    )
    here = docs.withColumn("__th", F.xxhash64(F.col(text)))
    joined = here.join(
        lost.select(F.col("doc_id").alias("__doc"), F.col("th").alias("__hash"), "__lost"),
        F.col(key).eqNullSafe(F.col("__doc")) & (F.col("__th") == F.col("__hash")),
        "left",
    )
    whole = lines(F.col(text))
    edges = F.concat(F.array(F.lit(-1)), F.coalesce("__lost", F.array().cast("array<int>")), F.array(F.size("__lines")))
    between = F.transform(
        F.sequence(F.lit(1), F.size("__edges") - 1),
        lambda i: F.slice(
            F.col("__lines"),
            F.element_at("__edges", i) + 2,
            F.element_at("__edges", i + 1) - F.element_at("__edges", i) - 1,
        ),
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    return (
        joined.withColumn("__lines", whole)
        .withColumn("__edges", edges)
        .select(
            *kept,
            F.size("__lines").cast("long").alias("n_lines"),
            (F.size("__edges") - 2).cast("long").alias("n_dropped"),
            F.array_join(F.flatten(between), "\n").alias("kept_text"),
        )
    )
