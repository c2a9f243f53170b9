"""URL filter: explicit rules, and a path-template tree for the other pages.

Paths are counted per host with runs of digits written as the wildcard. Level
by level, a node whose children are many and rarely repeat gets one wildcard
child; a branch joins the largest sibling with the same commonest rest of path
if the counts of their rests have the same distribution and, where both hold
labelled pages, so have these pages' labels (chi-square tests). What comes out
is the template of each path; the tree ends with the longest path that still
shares its node with another.

A template's purity is its smoothed share of blocked pages among the labelled
ones. It is smoothed twice: the same template over all hosts by the prior, and
the template of a host by that, so a host without labels is judged by what its
templates are worth elsewhere, and one with labels by its own. A template is
rejected at ``reject_at``.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no rule; a null page id passes through; repeated rows are judged
alike, row by row; without labels every template keeps the prior, which
allows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rides.llm.common import ASCII_LOWER, ASCII_UPPER, col, prepare, saved

ALLOW, BLOCK = "allow", "block"
# A node is variable with more children than this, seen less than twice each.
MANY = 16
WILD = "*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return (F.coalesce(F.translate(host, ASCII_UPPER, ASCII_LOWER), F.lit("")),
            F.coalesce(path, F.lit("")))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, as it is written (``net/``), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        out = F.when(fits, rule).otherwise(out)
    return out


def _generalised(paths: DataFrame, level: int) -> DataFrame:
    """Replace the segment of a variable node by the wildcard."""
    node = ["host", "template"]
    children = paths.groupBy(*node, F.get("segments", F.lit(level)).alias("seg")).agg(F.sum("n").alias("n"))
    variable = children.where("seg is not null").groupBy(*node).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).where(
            (F.col("k") > MANY) & (F.col("n") < 2 * F.col("k"))).select(*node, F.lit(True).alias("wild"))
    seg = F.get("segments", F.lit(level))
    return paths.join(variable, node, "left").withColumn(
        "seg", F.when(seg.isNotNull() & F.col("wild"), WILD).otherwise(seg)).drop("wild")


def _merged(paths: DataFrame, level: int) -> DataFrame:
    """Give branches the name of the largest sibling they are alike."""
    node = ["host", "template"]
    rest = F.concat_ws("/", F.slice("segments", level + 2, F.size("segments")))
    seen = (paths.where("seg is not null").groupBy(*node, "seg", rest.alias("rest"))
                 .agg(F.sum("n").alias("c"), F.sum("n_block").alias("bad"), F.sum("n_allow").alias("good")))
    sizes = seen.groupBy(*node, "seg").agg(
        F.sum("c").alias("total"), F.max_by("rest", F.struct("c", "rest")).alias("top"),
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("cells"))
    lead = sizes.groupBy(*node, "top").agg(F.min(F.struct(
        -F.col("total"), F.col("seg").alias("lead"), F.col("total").alias("lead_total"),
        F.col("bad").alias("lead_bad"), F.col("good").alias("lead_good"),
        F.col("cells").alias("lead_cells"))).alias("best")).select(
            *node, "top", "best.lead", "best.lead_total", "best.lead_bad", "best.lead_good", "best.lead_cells")
    others = sizes.join(lead, [*node, "top"]).where("seg != lead").drop("top")
    # X^2 over the rests of a branch and its lead: the branch's rests first,
    # then the lead's that the branch lacks (each adds its own share).
    own = (seen.select(*node, "seg", "rest", "c").join(others, [*node, "seg"])
               .join(seen.select(*node, F.col("seg").alias("lead"), "rest", F.col("c").alias("lead_c")),
                     [*node, "lead", "rest"], "left").fillna(0, ["lead_c"]))
    a, b = F.col("c"), F.col("lead_c")
    n, m = F.col("total"), F.col("lead_total")
    term = (a * F.sqrt(m / n) - b * F.sqrt(n / m)) ** 2 / (a + b)
    test = own.groupBy(*node, "seg", "lead", "total", "lead_total", "bad", "good", "lead_bad", "lead_good",
                       "cells", "lead_cells").agg(
        F.sum(term).alias("x2"), F.sum("lead_c").alias("shared"), F.count_if(b > 0).alias("common"))
    x2 = F.col("x2") + (m - F.col("shared")) * n / m    # a rest of the lead alone adds lead_c * n / m
    freedom = F.greatest(F.col("cells") + F.col("lead_cells") - F.col("common") - 1, F.lit(1))
    alike = test.where((x2 <= _limit(freedom)) & (_labels_differ() <= _limit(F.lit(1)))).select(*node, "seg", "lead")
    return paths.join(alike, [*node, "seg"], "left").withColumn(
        "seg", F.coalesce("lead", "seg")).drop("lead")


def _limit(freedom: Column) -> Column:
    return freedom + 3 * F.sqrt(2 * freedom)


def _labels_differ() -> Column:
    """X^2 of blocked and allowed pages of a branch and its lead; 0 where one
    of them, or one outcome, has none."""
    a, b, c, d = (F.col(x).cast("double") for x in ("bad", "good", "lead_bad", "lead_good"))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return F.when(margins > 0, (a * d - b * c) ** 2 * (a + b + c + d) / margins).otherwise(0.0)


def templates(paths: DataFrame) -> DataFrame:
    """host, masked, n, n_block, n_allow, template of counted masked paths. A
    path that has its node for itself is complete: nothing below can vary or
    have a sibling. So the levels end with the longest path that others share."""
    open_paths = paths.withColumn("segments", F.split("masked", "/")).withColumn("template", F.lit(""))
    done, level = None, 0
    while True:
        node = ["host", "template"]
        alone = open_paths.groupBy(*node).agg(F.count(F.lit(1)).alias("k")).where("k = 1").select(
            *node, F.lit(True).alias("alone"))
        marked = saved(open_paths.join(alone, node, "left").withColumn(
            "ends", F.coalesce("alone", F.lit(False)) | (F.size("segments") <= level + 1)).drop("alone"), "url-tree")
        rest = F.slice("segments", level + 2, F.size("segments"))
        ended = marked.where("ends").withColumn("template", F.when(F.size(rest) > 0, F.concat(
            F.col("template"), F.lit("/"), F.array_join(rest, "/"))).otherwise(F.col("template")))
        done = ended if done is None else done.unionByName(ended)
        open_paths = marked.where("not ends").drop("ends")
        if open_paths.isEmpty():
            return done.drop("segments", "ends")
        level += 1
        step = _merged(_generalised(open_paths, level), level)
        open_paths = step.withColumn("template", F.concat_ws("/", "template", "seg")).drop("seg")


def purities(tree: DataFrame, weight: float, prior: float) -> DataFrame:
    """host, template, purity: the blocked share of the template's labelled
    pages, smoothed by its purity over all hosts, itself smoothed by ``prior``."""
    own = tree.groupBy("host", "template").agg(F.sum("n_block").alias("bad"), F.sum("n_allow").alias("good"))
    every = own.groupBy("template").agg(
        ((F.sum("bad") + weight * prior) / (F.sum("bad") + F.sum("good") + weight)).alias("elsewhere"))
    return own.join(every, "template").select("host", "template", (
        (F.col("bad") + weight * F.col("elsewhere")) / (F.col("bad") + F.col("good") + weight)).alias("purity"))


def judge(pages: DataFrame, rules: dict[str, str], labels: DataFrame | None = None,
          weight: float = 5.0, prior: float = 0.1, reject_at: float = 0.5,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, template, purity, verdict of every page.

    ``labels`` (page_id, blocked boolean) are known verdicts; without them the
    pages that a rule decides are the labelled ones, and what a rule says of a
    template on the hosts it covers counts for that template elsewhere. A purity
    is ``(blocked + weight * p) / (labelled + weight)``, where p is the
    template's purity over all hosts, and for that ``prior``."""
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url")) \
        .select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, says in rules.items():
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    rows = rows.withColumn("ruled", verdict).withColumn("masked", F.regexp_replace("path", "[0-9]+", WILD))
    known = rows.withColumn("blocked", F.col("ruled") == BLOCK)
    if labels is not None:
        known = rows.join(labels.select("page_id", "blocked"), "page_id", "left")
    counted = known.groupBy("host", "masked").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("blocked")).alias("n_block"),
        F.count_if(~F.col("blocked")).alias("n_allow"))
    tree = saved(templates(saved(counted, "url-paths")), "url-templates")
    judged = tree.join(purities(tree, weight, prior), ["host", "template"]).select(
        "host", "masked", "template", "purity")
    return rows.join(judged, ["host", "masked"], "left").select(
        "page_id", "host", "path", "rule", "template", "purity",
        F.coalesce("ruled", F.when(F.col("purity") >= reject_at, BLOCK).otherwise(ALLOW)).alias("verdict"))
