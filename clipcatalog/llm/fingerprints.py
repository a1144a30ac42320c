"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A shingle is a word and the four before it; the first four words have as many before them
as there are, so a text of any length has one shingle per word and its first words are not
lost.  Words are runs of other signs than blank and \\t-\\r, in lower case.  The sketch of a
text is the ``k`` smallest distinct 64-bit hashes of its shingles, sorted.  The sketch of two
texts together is the sketch of their sketches, so parts can be sketched anywhere and
merged in any order (``merged``, ``merged_sketches``).

* ``resemblance``: shared part of the ``k`` smallest hashes of both; exact while both sets
  together have at most ``k`` shingles, else its deviation is at most 0.5 / sqrt(k).
* ``distinct_shingles``: exact below ``k``, else (k - 1) / (k-th hash as a fraction of its range).
* ``containment``: share of the first set that is in the second, from both.

Null and empty texts have an empty sketch and an empty fingerprint; two empty ones resemble
each other with 1, an empty and another one with 0.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import settled

K, WIDTH = 128, 5
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def sketch_of(words_: str, k: int = K, width: int = WIDTH) -> Column:
    """Sketch of a *column* of words, named so that its array is not evaluated again per word."""

    def shingle(word: Column, at: Column) -> Column:
        before = (F.get(F.col(words_), at - n) for n in range(width - 1, 0, -1))
        return F.xxhash64(*before, word)

    return F.slice(F.sort_array(F.array_distinct(F.transform(words_, shingle))), 1, k)


def sketched(df: DataFrame, text: str = "text", name: str = "sketch", k: int = K, width: int = WIDTH) -> DataFrame:
    """Add the sketch of a text column."""
    own = f"{name}_words"
    staged = df.withColumn(own, F.explode(F.array(words(F.col(text)))))  # one row each; keeps the array in one place
    return staged.withColumn(name, sketch_of(own, k, width)).drop(own)


def merged(*sketches: Column, k: int = K) -> Column:
    """Sketch of several parts of one text or set."""
    return F.slice(F.sort_array(reduce(F.array_union, sketches)), 1, k)


def merged_sketches(df: DataFrame, keys: list[str], name: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from any number of rows: ``keys, sketch``.

    Distinct hashes are combined before the shuffle, and every task passes on at most ``k``
    of a key, so a key may hold any share of the rows.
    """
    every = df.select(*keys, F.explode(name).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    least = every.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(name))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    both = merged(a, b, k=k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both).cast("double"))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    last = (F.get(sketch, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(k - 1.0) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of the first set that the second holds, 0 to 1."""
    of_both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k=k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), of_both / distinct_shingles(a, k)))


def fingerprint(sketch: Column) -> Column:
    """A sketch as text: its hashes as 8 bytes each, in base 64."""
    packed = F.unhex(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))
    return F.translate(F.base64(packed), "\r\n", "")  # a setting of the session decides on line ends


def from_fingerprint(column: str) -> Column:
    """The sketch of a fingerprint column, to merge and compare stored ones."""
    count = (F.octet_length(F.unbase64(column)) / 8).cast("int")
    one = lambda i: F.conv(F.substring(F.hex(F.unbase64(column)), i * 16 + 1, F.lit(16)), 16, -10).cast("long")
    return F.when(count == 0, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), count - 1), one))


KEY = ["missing", "key"]


def successors(rows: DataFrame) -> DataFrame:
    """Whom a document follows when ids descend: ``missing, key, to_missing, to_key, need``.

    One row per id of ``rows(missing, key, text)``; a missing id comes last, and the first id
    follows the last one.  ``need`` is how many signs the document in front takes at most.
    Ids are ranged by Spark; within a range a window finds the neighbours, and only the ends
    of the ranges, as many as there are partitions, meet in one task.
    """
    ids = rows.groupBy(*KEY).agg(F.max(F.length("text")).alias("n"))
    ranged = settled(ids.repartitionByRange("missing", F.desc("key")).withColumn("range", F.spark_partition_id()), "ranged")
    me = F.struct("missing", F.bitwise_not("key").alias("down"), "key", "n")
    ends = ranged.groupBy("range").agg(F.max(me).alias("last"))
    in_turn = Window.orderBy("range")
    ends = ends.select("range", F.coalesce(F.lag("last").over(in_turn), F.last("last").over(
        in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("ahead"))
    ahead = F.lag(me).over(Window.partitionBy("range").orderBy("missing", F.desc("key")))
    placed = ranged.withColumn("own", ahead).join(ends, "range").withColumn("to", F.coalesce("own", "ahead"))
    return placed.select(*KEY, F.col("to.missing").alias("to_missing"), F.col("to.key").alias("to_key"),
                         F.floor(F.col("to.n") / 3).cast("int").alias("need"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    for every row; then ``n_shingles``, ``n_next_shingles`` (estimates) and ``in_edited`` (containment).
    In the edited text the last third of the signs gives way to the first as many (or all) of the
    next document by descending id.  Rows with a null id are one document after all others.
    Where rows share an id, the next document of the one in front is the text with the smallest
    hash.  Texts are shuffled once, their beginnings once more.
    """
    rows = docs.select(
        F.col(doc_id).isNull().alias("missing"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    places = settled(successors(rows), "places")
    own = sketched(rows, k=k, width=width)
    one = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.xxhash64("text")))
    sent = (
        own.join(places.hint("shuffle_hash"), KEY).withColumn("nth", one).where("nth = 1")
        .select(F.col("to_missing").alias("missing"), F.col("to_key").alias("key"),
                F.left(F.col("text"), F.col("need")).alias("start"), F.col("sketch").alias("next_sketch"))
    )
    met = own.hint("merge").join(sent, KEY)
    third = F.floor(F.length("text") / 3).cast("int")
    met = met.withColumn("edited", F.concat(
        F.left(F.col("text"), F.length("text") - third), F.left(F.col("start"), third)))
    made = sketched(met, "edited", "edited_sketch", k, width)
    mine, new, other = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return made.select(
        F.when(~F.col("missing"), F.col("key")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), fingerprint(mine).alias("fingerprint"),
        fingerprint(new).alias("edited_fingerprint"), resemblance(mine, new, k).alias("near_edited"),
        resemblance(mine, other, k).alias("near_next"), distinct_shingles(mine, k).alias("n_shingles"),
        distinct_shingles(other, k).alias("n_next_shingles"), containment(mine, new, k).alias("in_edited"))
