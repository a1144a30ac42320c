"""Vocabulary files: plain lines, JSON lists, or lists grouped by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcatalog.functions.columns import strip


def load_terms(spark: SparkSession, path: str | None, defaults: list[str] | None = None,
               kind: str = "lines") -> DataFrame:
    """Terms of a vocabulary file as one column ``term``.

    ``kind``: ``lines`` (``#`` comment lines skipped, a leading ``#`` removed),
    ``json`` (a list, ``{"creators": [...]}``, or lists by language under
    ``creators_by_language``, flattened and made distinct).  Without a path the
    defaults are returned.
    """
    if not path:
        return spark.createDataFrame([(t,) for t in defaults or []], "term string")
    if kind == "lines":
        line = strip("value")
        # comment lines are skipped first, so no leading "#" is left to remove
        return (
            spark.read.text(path).select(line.alias("term"))
            .filter((F.col("term") != "") & ~F.startswith(F.col("term"), F.lit("#")))
        )
    # A vocabulary document is one JSON value, so it is read whole.
    doc = strip("value")
    listed = F.from_json(doc, "array<string>")
    named = F.from_json(F.get_json_object(doc, "$.creators"), "array<string>")
    grouped = F.from_json(F.get_json_object(doc, "$.creators_by_language"), "map<string,array<string>>")
    flat = F.array_distinct(F.flatten(F.filter(F.map_values(grouped), lambda v: v.isNotNull())))
    terms = F.when(doc.startswith("["), listed).otherwise(F.coalesce(named, flat))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(terms).alias("term"))
        .select(strip("term").alias("term"))
        .filter("term != ''")
    )
