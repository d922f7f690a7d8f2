r"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate (menus, licences, notices).
Every line (trimmed, 128-bit hash) gets a HyperLogLog++ sketch of its sites;
the sketches merge in the aggregation, so a line that a third of all rows hold
is one row a map task before the shuffle. Lines whose estimate is far above
``min_sites`` are boilerplate, those at one site are not, and those between
get an exact distinct count. Boilerplate lines are then taken out of every
text.

Lines spread over many sites are also those of a document that was copied to
them. These are told apart by the texts they stand in: of boilerplate most
texts hold much else, of copies most texts consist of such lines. So a spread
line stays if more than half of the distinct texts that hold it are spread
lines for more than half of their characters (the near-duplicate step decides
on them); every other one goes from every text.

Only Spark's own expressions run. Texts are matched to their removed lines by
the text's 128-bit hash, so repeated ids and copies need no special care, and
hot keys meet in joins that adaptive execution can split.

Cases: null text stays null; null sites are no site; blank lines are never
removed; lines cut at ``\n``; an empty table gives no rows; other columns
(whatever their names) are carried through, but ``_removed_lines`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import put_back, set_aside
from ledgerlake.session import write_scratch_table

MIN_SITES = 8
#: 128 registers: 13 longs a line in the shuffle, mostly zeros.
SKETCH_ERROR = 0.1
EDGE = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, EDGE, "")


def _lines(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """One row per line that is not blank: its number and hash."""
    rows = docs.select(*more, F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("_at", "_line"))
    rows = rows.withColumn("_line", trimmed(F.col("_line"))).filter("_line <> ''")
    return rows.withColumns({"_la": F.xxhash64("_line"), "_lb": F.xxhash64(F.lit("line"), "_line")})


def boilerplate_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """Hashes (_la, _lb) of the lines found on at least ``min_sites`` sites: boilerplate, and lines of copies."""
    lines = _lines(docs, text_col, F.col(site_col).alias("_site"))
    sketched = write_scratch_table(
        lines.groupBy("_la", "_lb")
        .agg(F.approx_count_distinct("_site", SKETCH_ERROR).alias("_sites"))
        .filter(F.col("_sites") >= min(2, min_sites)),
        "line_sites",
    )
    sure = sketched.filter(F.col("_sites") > 2 * min_sites).select("_la", "_lb")
    near = sketched.filter(F.col("_sites") <= 2 * min_sites).select("_la", "_lb")
    counted = (
        lines.join(near, ["_la", "_lb"], "left_semi")
        .groupBy("_la", "_lb")
        .agg(F.count_distinct("_site").alias("_sites"))
        .filter(F.col("_sites") >= min_sites)
        .select("_la", "_lb")
    )
    return sure.unionByName(counted)


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    site_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and ``_removed_lines`` (long) added.

    Small tables (sketches of lines on several sites, spread lines and where
    they stand) are written to the shared scratch folder while the plan is built.
    """
    columns = [c for c in docs.columns if c != "_removed_lines"]
    docs, names = set_aside(docs, text_col, site_col)
    spread = write_scratch_table(boilerplate_lines(docs, min_sites, site_col, text_col), "spread_lines")
    whole = F.coalesce(F.col(text_col), F.lit(""))
    keys = [F.xxhash64(whole).alias("_ta"), F.xxhash64(F.lit("text"), whole).alias("_tb")]
    # One row per distinct text that holds spread lines.
    held = write_scratch_table(
        _lines(docs, text_col, *keys, F.length(whole).alias("_size"))
        .join(spread, ["_la", "_lb"])
        .groupBy("_ta", "_tb", "_size")
        .agg(F.collect_set(F.struct("_at", F.length("_line").alias("_n"), "_la", "_lb")).alias("_held")),
        "held_lines",
    )
    mostly = 2 * F.aggregate("_held._n", F.lit(0), lambda a, x: a + x) > F.col("_size")
    lines = held.select("_ta", "_tb", mostly.alias("_mostly"), F.explode("_held").alias("_h"))
    copied = (
        lines.select("_ta", "_tb", "_mostly", "_h._la", "_h._lb")
        .distinct()
        .groupBy("_la", "_lb")
        .agg(F.count("*").alias("_texts"), F.count_if("_mostly").alias("_copies"))
        .filter(2 * F.col("_copies") > F.col("_texts"))
        .select("_la", "_lb")
    )
    removed = (
        lines.select("_ta", "_tb", "_h._at", "_h._la", "_h._lb")
        .join(copied, ["_la", "_lb"], "left_anti")
        .groupBy(F.col("_ta").alias("_ra"), F.col("_tb").alias("_rb"))
        .agg(F.collect_set("_at").alias("_gone"))
        .withColumn("_gone", F.map_from_arrays("_gone", F.transform("_gone", lambda _: F.lit(True))))
    )
    removed = write_scratch_table(removed, "removed_lines")
    # The keys are columns of their own, so that both join sides are plain shuffles.
    keyed = docs.withColumns({"_ta": keys[0], "_tb": keys[1]})
    joined = keyed.join(removed, (F.col("_ta") == F.col("_ra")) & (F.col("_tb") == F.col("_rb")), "left")
    cut = F.col("_gone").isNotNull()
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.map_contains_key(F.col("_gone"), i))
    return joined.withColumns(
        {
            text_col: F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text_col)),
            "_removed_lines": F.when(cut, F.size("_gone")).otherwise(0).cast("long"),
        }
    ).select(*put_back(columns, names), "_removed_lines")


def line_digest(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its lines, how many went, and the SHA-256 of what is left."""
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    counted = docs.withColumn("_n_lines", n_lines)
    return remove_boilerplate(counted, **options).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_removed_lines").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
