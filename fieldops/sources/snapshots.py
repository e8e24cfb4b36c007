"""A03 / C15 — immutable NDJSON snapshot files with metadata carried in the path.

Layout: ``<root>/<kind>/<YYYY-MM>/<YYYYmmddTHHMMSS>Z.ndjson``; one file = the complete state of one
(kind, month) at extraction time.  Only the newest file of a period counts: a row missing from it has
been revoked.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_snapshots(spark: SparkSession, root: str, schema: T.StructType | str,
                   kind_pattern: str = r"/([^/]+)/\d{4}-\d{2}/[^/]+\.ndjson$",
                   period_pattern: str = r"/(\d{4}-\d{2})/[^/]+\.ndjson$",
                   stamp_pattern: str = r"/([^/.]+)\.ndjson$", file_glob: str = "*.ndjson") -> DataFrame:
    """Read every snapshot file under ``root`` and add kind, period, file name and extraction time.

    The three patterns locate kind, period (YYYY-MM) and extraction stamp in the file path; the
    defaults match ``<kind>/<YYYY-MM>/<stamp>Z.ndjson``, other layouts pass their own.
    """
    df = (spark.read.schema(schema).option("recursiveFileLookup", "true")
          .option("pathGlobFilter", file_glob).json(root))
    path = F.col("_metadata.file_path")
    period = F.regexp_extract(path, period_pattern, 1)
    stamp = F.regexp_extract(path, stamp_pattern, 1)
    return (df.withColumn("kind", F.nullif(F.regexp_extract(path, kind_pattern, 1), F.lit("")))
              .withColumn("periode", F.nullif(period, F.lit("")))
              .withColumn("periode_date", F.try_to_date(F.concat(F.col("periode"), F.lit("-01"))))
              .withColumn("source_file", F.regexp_extract(path, r"([^/]+)$", 1))
              .withColumn("extracted_at",
                          F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmss'Z'"))))


def latest_snapshot(df: DataFrame, period_cols: Sequence[str] = ("periode",),
                    loaded_col: str = "extracted_at") -> DataFrame:
    """C15 — keep rows of the newest load per period.

    Written as aggregate + join rather than ``max() over (partition by period)``: a month can hold a
    third of all rows, and the window would pull it into one task.  The aggregate is partial
    (map-side) and yields one row per period, which the join side then receives cheaply.
    """
    keys = list(period_cols)
    newest = df.groupBy(*keys).agg(F.max(loaded_col).alias("_newest"))
    return (df.join(newest, keys, "inner")
              .where(F.col(loaded_col) == F.col("_newest"))
              .drop("_newest"))
