"""Built-in seed: product size labels."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE_LABEL_SCHEMA = ("size_code string, size_label string, size_description string, "
                     "serves_min int, serves_max int, sort_order int")

# The size-label seed (code, label, description, serves min/max, sort order).
SIZE_LABELS = [
    ("S", "Small", "Personal size pizza", 1, 2, 1),
    ("M", "Medium", "Standard sharing size", 2, 3, 2),
    ("L", "Large", "Family size pizza", 3, 4, 3),
    ("XL", "X-Large", "Party size pizza", 4, 5, 4),
    ("XXL", "XX-Large", "Extra large party size", 5, 6, 5),
]


def size_labels(spark: SparkSession) -> DataFrame:
    """The five-row size-label seed as a DataFrame (a fixed, tiny lookup)."""
    return spark.createDataFrame(SIZE_LABELS, SIZE_LABEL_SCHEMA)


def packaged_seed(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A CSV file of this package as a typed DataFrame. The driver reads the
    file (executors need not have it); Spark's CSV parser reads the lines.
    The header must name the schema's columns in order."""
    lines = files("brickyard.sources").joinpath(name).read_text(encoding="utf-8").splitlines()
    want = [c.split()[0] for c in schema.split(", ")]
    if lines[0].split(",") != want:
        raise ValueError(f"{name}: header {lines[0]!r} does not name {want}")
    rows = spark.createDataFrame([(x,) for x in lines[1:] if x], "line string")
    return rows.select(F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
