"""Line de-duplication over a generalised suffix array of line sequences.

Each document is the sequence of its non-blank lines. The suffixes (a document from one line on) are ranked by
distributed prefix doubling: the rank of a suffix at level k is the first position, in corpus order, of a suffix with
the same 2^k lines; level k + 1 joins the ranks at i and i + 2^k. Only suffixes that share their rank go on to the next
level, so that tables shrink with each level. A longest-common-prefix interval of length n is the set of suffixes whose
ranks agree at i and at i + n - 2^k (the two overlapping halves of n lines).

A repeated run counts if it has ``min_chars`` characters. To find which lines lie in such a run it is enough to test,
for each line, the shortest runs of that size that start and that end with it: an interval whose first member is an
earlier position marks its run as a later copy. Overlapping copies merge into maximal runs, and their lines go.
Levels therefore end where 2^k exceeds the lines of the longest such shortest run. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import rank_id, row_key, staged

MIN_CHARS = 60
_POSITION = ("rank_id", "row_key", "place")


def _sequences(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per document its non-blank lines (index, two hashes) and the shortest runs of ``min_chars``."""
    lines = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line, at: F.struct(
            at.alias("line"),
            F.length(F.trim(line)).alias("chars"),
            F.xxhash64(line).alias("print_a"),
            F.xxhash64(F.lit("line"), line).alias("print_b"),
        ),
    )
    shaped = (
        docs.select(
            rank_id().alias("rank_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text")
        )
        .withColumn("lines", F.filter(lines, lambda line: line["chars"] > 0))
        .where(F.size("lines") > 0)
        .select("rank_id", "row_key", "lines")
    )
    # Lines that the shortest run starting, and ending, with a line has; null where the document has too few characters.
    count = f"""aggregate({{slice}}, struct(0 as n, 0 as chars),
        (run, x) -> if(run.chars >= {min_chars}, run, struct(run.n + 1 as n, run.chars + x.chars as chars)),
        run -> if(run.chars >= {min_chars}, run.n, null))"""
    onwards = count.format(slice=f"slice(lines, i + 1, {min_chars})")
    back = count.format(slice=f"reverse(slice(lines, greatest(1, i + 2 - {min_chars}), least({min_chars}, i + 1)))")
    return shaped.withColumn(
        "lines",
        F.expr(
            f"""transform(lines, (line, i) -> struct(line.line, line.print_a, line.print_b,
                if(line.chars >= {min_chars}, 1, {onwards}) as onwards, if(line.chars >= {min_chars}, 1, {back}) as back))"""
        ),
    )


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` occur at several positions, with the first of these as ``rank``."""
    first = (
        rows.groupBy(*keys)
        .agg(F.min(F.struct(*_POSITION)).alias("rank"), F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
        .drop("n_rows")
    )
    return rows.join(first, keys)


def _at(rows: DataFrame, place: str, ranks: DataFrame, name: str) -> DataFrame:
    """``rows`` with the rank that the suffix at their document's line ``place`` has at their level."""
    own = ranks.select(*_POSITION, "level", F.col("rank").alias(name)).withColumnRenamed("place", place)
    return rows.join(own, ["rank_id", "row_key", place, "level"])


def later_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """rank_id, row_key and the lines (indices within the text) that lie in a repeated run and are not its first copy."""
    sequences = staged(
        _sequences(docs, min_chars)
        .dropDuplicates(["rank_id", "row_key"])
        .select("rank_id", "row_key", F.posexplode("lines").alias("place", "line"))
        .select(*_POSITION, "line.*"),
        "lines",
    )
    level, ranks = 0, staged(
        _classes(sequences, ["print_a", "print_b"]).select(*_POSITION, F.lit(0).alias("level"), "rank"), "ranks"
    )
    longest = sequences.agg(F.greatest(F.max("onwards"), F.max("back"))).first()[0] or 0
    current = ranks
    while 2 ** (level + 1) <= longest and not current.isEmpty():
        nxt = current.select(
            "rank_id", "row_key", (F.col("place") - 2**level).alias("place"), F.col("rank").alias("next_rank")
        )
        level += 1
        current = staged(
            _classes(current.drop("level").withColumnRenamed("rank", "own_rank").join(nxt, list(_POSITION)), ["own_rank", "next_rank"])
            .select(*_POSITION, F.lit(level).alias("level"), "rank"),
            "ranks",
        )
        ranks = ranks.unionByName(current)
    intervals = (
        sequences.where("onwards is not null")
        .select(*_POSITION, F.col("onwards").alias("n"))
        .union(
            sequences.where("back is not null").select(
                "rank_id", "row_key", F.expr("place - back + 1").alias("place"), F.col("back").alias("n")
            )
        )
    )
    # A run of one line needs no second half.
    halves = intervals.withColumn("level", F.expr("cast(floor(log2(n) + 1e-9) as int)"))
    both = _at(halves.withColumn("second", F.expr("place + n - cast(pow(2, level) as int)")), "place", ranks, "rank_a")
    both = _at(both.where("n > 1"), "second", ranks, "rank_b").unionByName(both.where("n = 1").withColumn("rank_b", F.col("rank_a")))
    members = both.select(*_POSITION, "n", "rank_a", "rank_b").distinct()
    copies = _classes(members, ["n", "rank_a", "rank_b"]).where(F.struct(*_POSITION) > F.col("rank"))
    places = copies.select("rank_id", "row_key", F.explode(F.expr("sequence(place, place + n - 1)")).alias("place"))
    return (
        sequences.select(*_POSITION, "line")
        .join(places.distinct(), list(_POSITION), "left_semi")
        .groupBy("rank_id", "row_key")
        .agg(F.collect_list("line").alias("removed"))
    )


def deduplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` with ``text`` freed of later copies of repeated runs of lines, and the columns
    ``lines_before``, ``lines_removed`` (columns of these names are replaced).

    A run is one or more consecutive non-blank lines of a document, equal character by character, with at least
    ``min_chars`` characters (outer blanks of a line not counted). The first copy by doc_id and place stays, also where
    copies lie in one document and where they overlap. Blank lines are never removed and do not separate runs. Null
    texts stay null, rows without doc_id come last, and rows alike in doc_id and text count as one document, returned
    as often as it occurs.
    """
    if min_chars < 1:
        raise ValueError("min_chars must be positive")
    names = [name for name in docs.columns if name not in ("lines_before", "lines_removed")]
    removals = later_copies(docs, min_chars).withColumnsRenamed({"rank_id": "__rank_id", "row_key": "__row_key"})
    keyed = docs.select(*[F.col(f"`{name}`") for name in names], rank_id().alias("__rank_id"), row_key().alias("__row_key"))
    joined = keyed.join(removals.withColumnRenamed("removed", "__removed"), ["__rank_id", "__row_key"], "left")
    # A generator is not merged into the expressions above it: the text is split once, not once for each line.
    lines = F.explode(F.array(F.when(F.col("__removed").isNotNull(), F.split("text", "\n")))).alias("__lines")
    rest = F.expr("""array_join(transform(array_except(sequence(0, size(__lines) - 1), __removed), i -> get(__lines, i)), '\n')""")
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(rest)
    return joined.select("*", lines).select(
        *[text.alias(name) if name == "text" else F.col(f"`{name}`") for name in names],
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("lines_before"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("lines_removed"),
    )
