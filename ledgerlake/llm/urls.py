r"""URL filter by a path-template tree.

Each host has a tree of path segments. Runs of digits are wildcards from the
start. Then, level by level below the host, a segment becomes ``*`` if the
labels below it do not differ from those of all its siblings (a two-proportion
test at ``z``; with fewer than ``min_labelled`` labels there is no telling
them apart): similar branches merge. A variable part of the path (its parent
has more than ``max_children`` different segments and this one holds less than
their even share of the pages) is compared at ``z_variable``, as so many tests
at once would find differences by chance; one that differs stays. Where fewer
than ``min_labelled`` labels are left below a node, all below it is ``**``,
however deep. A template is a path through the merged tree. Its purity is the share
of good pages among its labelled pages, smoothed by ``strength`` pages of its
host's purity, itself smoothed towards that of all pages; a template below
``min_purity`` is blocked.

Explicit rules go first: a rule ``host/path`` fits its host and all
subdomains if the url's path starts with the rule's path; the longest fits.

Pages are first counted per (host, path shape), so all further work is on
distinct shapes: only Spark's own aggregations and joins, no window over a
host. The verdicts are joined back by host and shape, written to the shared
scratch folder first, so that a host with a third of all pages is split by
adaptive execution.

Cases: a url that is null or has no ``://`` has an empty host and path, and
is judged as the template of that empty host; empty segments are ignored;
repeated pages count and are judged each; an empty table gives no rows; no
labels at all: purity 1, nothing is blocked by the tree; other columns are
carried through, whatever their names; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import put_back, set_aside
from ledgerlake.session import write_scratch_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (host, path start, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@dataclass(frozen=True)
class TreeOptions:
    max_children: int = 50
    min_labelled: int = 10
    z: float = 1.96
    z_variable: float = 3.29
    strength: float = 10.0
    min_purity: float = 0.5


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def path_segments(path: Column) -> Column:
    """The path's segments, runs of digits as ``*`` (a star of the path itself as ``%star``)."""
    named = F.filter(F.split(F.replace(path, F.lit("*"), F.lit("%star")), "/"), lambda s: s != "")
    return F.transform(named, lambda s: F.regexp_replace(s, "[0-9]+", "*"))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def _purity(good: Column, labelled: Column, prior: Column, strength: float) -> Column:
    return (good + strength * prior) / (labelled + strength)


def path_templates(shapes: DataFrame, options: TreeOptions = TreeOptions()) -> DataFrame:
    """Merge the trees: ``shapes`` (host, segments, pages, labelled, bad) plus ``template``.

    One round a level, until no node has enough labels below it.
    """
    least = max(1, options.min_labelled)
    rows, level = shapes.withColumns({"template": F.lit(""), "_open": F.lit(True)}), 0
    while True:
        at = rows.withColumn("_seg", F.when(F.col("_open"), F.get("segments", F.lit(level))))
        children = write_scratch_table(
            at.filter("_seg is not null")
            .groupBy("host", "template", "_seg")
            .agg(F.sum("pages").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")),
            "url_children",
        )
        parents = children.groupBy(F.col("host").alias("_ph"), F.col("template").alias("_pt")).agg(
            F.count("*").alias("_kids"), F.sum("n").alias("_n"), F.sum("labelled").alias("_l"), F.sum("bad").alias("_b")
        )
        rate = F.try_divide("_b", "_l")
        gap = F.abs(F.try_divide("bad", "labelled") - rate)
        variable = (F.col("_kids") > options.max_children) & (F.col("n") * options.max_children < F.col("_n"))
        z = F.when(variable, options.z_variable).otherwise(options.z)
        similar = (F.col("labelled") < least) | (gap <= z * F.sqrt(F.try_divide(rate * (1 - rate), F.col("labelled"))))
        decided = write_scratch_table(
            children.join(parents, (F.col("host") == F.col("_ph")) & (F.col("template") == F.col("_pt"))).select(
                F.col("host").alias("_h"),
                F.col("template").alias("_t"),
                F.col("_seg").alias("_s"),
                F.when(F.col("_l") < least, "**").when(similar, "*").otherwise(F.col("_seg")).alias("_to"),
            ),
            "url_segments",
        )
        rows = (
            at.join(
                decided,
                (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("_seg") == F.col("_s")),
                "left",
            )
            .withColumns(
                {
                    "template": F.concat("template", F.coalesce(F.concat(F.lit("/"), "_to"), F.lit(""))),
                    "_open": F.coalesce(F.col("_to") != "**", F.lit(False)),
                }
            )
            .drop("_seg", "_h", "_t", "_s", "_to")
        )
        rows, level = write_scratch_table(rows, "url_templates"), level + 1
        if rows.filter(F.col("_open") & (F.size("segments") > level)).isEmpty():
            return rows.drop("_open")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    options: TreeOptions = TreeOptions(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``pages`` with host, path, template, rule (null if none) and verdict.

    ``labels``: one row (page id as ``_page``, ``_bad`` boolean) per labelled
    page. Tables over distinct path shapes are written while the plan is built.
    """
    out = ["host", "path", "template", "rule", "verdict"]
    columns = [c for c in pages.columns if c not in out or c in (id_col, url_col)]
    pages, names = set_aside(pages.select(*[f"`{c}`" for c in columns]), id_col, url_col)
    parts = pages.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    parts = parts.withColumn("_shape", F.array_join(path_segments(F.col("path")), "/"))

    marked = labels.groupBy("_page").agg(F.max(F.col("_bad").cast("long")).alias("_bad"))
    labelled = parts.select(F.col(id_col).alias("_id"), "host", "_shape").join(marked, F.col("_id") == F.col("_page"), "left")
    shapes = write_scratch_table(
        labelled.groupBy("host", "_shape").agg(
            F.count("*").alias("pages"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")
        ),
        "url_shapes",
    )
    split = shapes.withColumn("segments", F.filter(F.split("_shape", "/"), lambda s: s != ""))
    tree = path_templates(split, options)

    known, bad = shapes.agg(F.sum("labelled"), F.sum("bad")).first()
    prior = F.lit((known - bad) / known if known else 1.0)
    hosts = shapes.groupBy(F.col("host").alias("_h")).agg(F.sum("labelled").alias("_hl"), F.sum("bad").alias("_hb"))
    templates = tree.groupBy("host", "template").agg(F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"))
    host_purity = _purity(F.col("_hl") - F.col("_hb"), F.col("_hl"), prior, options.strength)
    purity = _purity(F.col("_l") - F.col("_b"), F.col("_l"), host_purity, options.strength)
    judged = templates.join(hosts, F.col("host") == F.col("_h")).select(
        F.col("host").alias("_th"),
        F.col("template").alias("_tt"),
        F.when(purity < options.min_purity, "block").otherwise("allow").alias("_verdict"),
    )
    verdicts = write_scratch_table(
        tree.join(judged, (F.col("host") == F.col("_th")) & (F.col("template") == F.col("_tt"))).select(
            F.col("host").alias("_vh"), F.col("_shape").alias("_vs"), "template", "_verdict"
        ),
        "url_verdicts",
    )
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    return (
        parts.join(verdicts, (F.col("host") == F.col("_vh")) & (F.col("_shape") == F.col("_vs")), "left")
        .withColumn("_rule", rule)
        .withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce("_rule.verdict", "_verdict")})
        .select(*put_back(columns, names), *out)
    )


def labels_by_document_number(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of pages whose path names a labelled document by its number: (_page, _bad).

    A page is bad if its document is of low quality or toxic.
    """
    number = F.regexp_extract(url_path(F.col("url")), r"/(\d{1,18})(?:[/.]|$)", 1)
    numbered = pages.select(F.col("page_id").alias("_page"), number.alias("_number"))
    numbered = numbered.filter("_number <> ''").withColumn("_doc", F.col("_number").cast("long"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("_bad")
    return numbered.join(labels.select(F.col("doc_id").alias("_d"), bad), F.col("_doc") == F.col("_d")).select("_page", "_bad")
