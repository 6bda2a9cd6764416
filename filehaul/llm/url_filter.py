"""URL filters by a tree of path templates, with built-in expressions only.

The paths of a host form a tree. Level by level, segments that few URLs have
become a wildcard of their shape, and frequent segments are merged into one
wildcard unless what follows them, or the labels below them, differs from that
of their siblings by more than chance (Hoeffding's bound). A template's labels
are smoothed by those of its host, and the host's by all; templates that are
not pure enough are rejected. A list of rules comes before the templates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import lower_ascii
from filehaul.storage import store_once

# Rules are part of the expression, so their number is limited.
MAX_RULES = 1000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; both are empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(after, "(?s)^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(after, "(?s)^[^/?#]*(/[^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else null.

    A rule is a host and the start of a path, such as ``net/es/``; it fits the
    host and its subdomains.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda each: len(each[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        fit = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def _shape(segment: Column) -> Column:
    """Runs of digits, of hexadecimal digits with both kinds, and of letters, each as one mark."""
    shape = F.regexp_replace(segment, "(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{8,}", "{x}")
    shape = F.regexp_replace(shape, "[0-9]+(?![^{]*\\})", "{0}")
    return F.regexp_replace(shape, "\\p{L}+(?![^{]*\\})", "{a}")


def path_templates(
    paths: DataFrame, min_share: float = 0.01, min_count: int = 20, alpha: float = 0.01, max_depth: int = 12
) -> DataFrame:
    """``template`` for rows ``host, path, n, n_labelled, n_good`` of distinct paths.

    A segment is frequent with ``min_count`` URLs and ``min_share`` of those of
    its parent, so a parent has at most ``1 / min_share`` of them. Segments
    after ``max_depth`` form one wildcard.
    """
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(
        F.split(F.substring("path", 2, 2**31 - 1), "/")
    )
    state, seen = store_once(
        paths.withColumns({"segments": segments, "template": F.lit("")}), "paths", {"depth": F.max(F.size("segments"))}
    )
    for level in range(min(seen["depth"] or 0, max_depth)):
        segment = F.get("segments", F.lit(level))
        following = F.when(F.size("segments") > level + 1, _shape(F.get("segments", F.lit(level + 1)))).otherwise("$")
        here = state.where(F.size("segments") > level).withColumns({"segment": segment, "following": following})
        kept = _frequent(here, min_share, min_count, alpha).select(
            F.col("host").alias("of_host"), F.col("template").alias("of_template"),
            F.col("segment").alias("of_segment"), "piece",
        )
        grown = (
            state.withColumn("segment", segment)
            .join(
                kept,
                (F.col("host") == F.col("of_host"))
                & (F.col("template") == F.col("of_template"))
                & (F.col("segment") == F.col("of_segment")),
                "left",
            )
            .withColumn(
                "template",
                F.when(F.col("segment").isNull(), F.col("template")).otherwise(
                    F.concat("template", F.lit("/"), F.coalesce("piece", _shape(F.col("segment"))))
                ),
            )
        )
        if level + 1 == max_depth:
            deeper = F.size("segments") > max_depth
            grown = grown.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template")))
        state, _ = store_once(grown.select(*state.columns), "paths")
    return state.drop("segments")


def _frequent(here: DataFrame, min_share: float, min_count: int, alpha: float) -> DataFrame:
    """``host, template, segment, piece`` of frequent segments; piece is the segment, or ``*`` where siblings are alike."""
    parent, branch = ["host", "template"], ["host", "template", "segment"]
    sums = [F.sum(name).alias(name) for name in ("n", "n_labelled", "n_good")]
    by_following, _ = store_once(here.groupBy(*branch, "following").agg(*sums), "branches")
    of_branch = by_following.groupBy(*branch).agg(*sums)
    of_parent = of_branch.groupBy(*parent).agg(
        F.sum("n").alias("all_n"), F.sum("n_labelled").alias("all_labelled"), F.sum("n_good").alias("all_good")
    )
    frequent = of_branch.join(of_parent, parent).where(
        (F.col("n") >= min_count) & (F.col("n") >= min_share * F.col("all_n"))
    )
    # What follows: the total variation between the branch and its siblings.
    pooled = by_following.groupBy(*parent, "following").agg(F.sum("n").alias("pooled"))
    shares = (
        frequent.select(*branch, F.col("n").alias("own"), "all_n")
        .join(by_following.select(*branch, "following", "n"), branch)
        .join(pooled, [*parent, "following"])
    )
    rest = F.col("all_n") - F.col("own")
    excess = F.col("n") / F.col("own") - F.when(rest > 0, (F.col("pooled") - F.col("n")) / rest).otherwise(F.lit(0.0))
    apart = shares.groupBy(*branch).agg(F.sum(F.greatest(excess, F.lit(0.0))).alias("apart"))

    def bound(own: Column, other: Column) -> Column:
        scale = math.sqrt(0.5 * math.log(2 / alpha))
        return F.when((own > 0) & (other > 0), scale * (1 / F.sqrt(own) + 1 / F.sqrt(other)))

    good_apart = F.abs(
        F.col("n_good") / F.nullif("n_labelled", F.lit(0))
        - (F.col("all_good") - F.col("n_good")) / F.nullif(F.col("all_labelled") - F.col("n_labelled"), F.lit(0))
    )
    alike = (F.col("apart") <= bound(F.col("n"), F.col("all_n") - F.col("n"))) & F.coalesce(
        good_apart <= bound(F.col("n_labelled"), F.col("all_labelled") - F.col("n_labelled")), F.lit(True)
    )
    piece = F.when(F.coalesce(alike, F.lit(False)), "*").otherwise(F.col("segment"))
    return frequent.join(apart, branch).select(*branch, piece.alias("piece"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    label_id_column: str = "doc_id",
    label_column: str = "quality",
    strength: float = 10.0,
    min_purity: float = 0.5,
    **tree,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``, one row per row.

    Labels are 1 for good and 0 for bad. ``strength`` is the number of labels
    that the host's purity weighs in a template's, and that of all labels in a
    host's; without any label the purity is 1. A page is blocked if the longest
    fitting rule says so, or without a rule if its template's purity is below
    ``min_purity``. A null URL, or one without ``://``, has an empty host and
    path, which form a template like any other. A null id has no label;
    repeated labels of an id count by their mean. Other columns are left out.
    """
    host, path = url_parts(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    marks = (
        labels.where(F.col(label_column).isin(0, 1))
        .groupBy(F.col(label_id_column).alias("label_id"))
        .agg(F.avg(label_column).alias("good"))
    )
    paths = (
        rows.join(marks, F.col("page_id") == F.col("label_id"), "left")
        .groupBy("host", "path")
        .agg(F.count("*").alias("n"), F.count("good").alias("n_labelled"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("n_good"))
    )
    placed = path_templates(paths, **tree)
    sums = [F.sum("n_labelled").alias("n_labelled"), F.sum("n_good").alias("n_good")]
    templates = placed.groupBy("host", "template").agg(*sums)
    hosts = templates.groupBy("host").agg(*sums)
    total = hosts.agg(*sums).first()
    prior = total["n_good"] / total["n_labelled"] if total["n_labelled"] else 1.0
    smooth = lambda below: (F.col("n_good") + strength * below) / (F.col("n_labelled") + strength)
    hosts = hosts.select("host", smooth(F.lit(prior)).alias("host_purity"))
    judged = templates.join(hosts, "host").select("host", "template", smooth(F.col("host_purity")).alias("purity"))
    known = placed.join(judged, ["host", "template"]).select("host", "path", "template", "purity")
    fit = match_rule(F.col("host"), F.col("path"), list(rules))
    own = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return (
        rows.join(known, ["host", "path"])
        .withColumn("fit", fit)
        .select(
            "page_id", "host", "path", F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", own).alias("verdict"), "template", "purity",
        )
    )
