"""URL filter by path-template trees.

Rules decide first. For all other urls a tree per host is grown over path segments,
level by level: segments that are variable by their form (numbers, long hex, ids,
mixtures of letters and digits, with any extension kept) become wildcards at once;
of a node's remaining children those whose labelled block rate does not differ
significantly from that of their siblings merge into one branch; a branch without
labels has no statistics to be alike by and stays apart; the number of siblings plays
no part. Merged branches and masked segments have names of their own. Each template then has a
smoothed purity: its labelled block rate on its host, drawn towards the rate of the
same template over all hosts, which is drawn towards a low prior. So evidence reaches
hosts without rules, and it takes evidence to reject. A template with a merged branch
means something else on each host and is drawn towards the low prior alone.
Labels are the verdicts of the rules. All counting is on distinct (host, path)
shapes with partial sums, so a hot host or template is added up before it moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.graph import written
from paperloom.session import cut

#: Prior block rate and its weight in urls; z-score that keeps a branch apart; purity that rejects.
PRIOR, STRENGTH, APART, REJECT = 0.1, 4.0, 3.0, 0.8

#: A segment that names one page rather than a section: digits, hex of 8 or more, or letters and digits mixed.
VARIABLE = r"^(?:[0-9]+|[0-9A-Fa-f-]{8,}|(?=[^.]*[0-9])[0-9A-Za-z_%~-]{6,})(?=\.|$)"

#: What alike children merge into: a name that no segment has, since it holds a slash.
MERGED = "/+"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest (host, path) rule that fits and its verdict, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grow(shapes: DataFrame) -> DataFrame:
    """``host, segments, n, blocked, labelled`` to the same with ``template``.

    One round per level; a path leaves the rounds when its segments are used up
    or when it is alone in its node.
    """
    done: list[DataFrame] = []
    live = shapes.withColumn("template", F.lit("")).withColumn("depth", F.lit(0))
    while True:
        live = cut(live)
        done.append(live.where(F.size("segments") <= F.col("depth")))
        live = live.where(F.size("segments") > F.col("depth"))
        if not live.limit(1).count():
            break
        here = live.withColumn("child", F.element_at("segments", F.col("depth") + 1))
        kids = here.groupBy("host", "template", "child").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("m"), F.count("*").alias("paths"))
        open_kid = F.col("child") != "*"
        node = kids.groupBy("host", "template").agg(
            F.count_if(open_kid).alias("kids"), F.sum("paths").alias("all_paths"), F.sum(F.when(open_kid, F.col("b"))).alias("all_b"), F.sum(F.when(open_kid, F.col("m"))).alias("all_m")
        )
        # Two-proportion test of a child against its siblings, on rates smoothed by one half.
        p = (F.col("all_b") + 0.5) / (F.col("all_m") + 1)
        rest_m = F.col("all_m") - F.col("m")
        z = F.abs((F.col("b") + 0.5) / (F.col("m") + 1) - (F.col("all_b") - F.col("b") + 0.5) / (rest_m + 1)) / F.sqrt(p * (1 - p) * (1 / (F.col("m") + 1) + 1 / (rest_m + 1)))
        alike = (F.col("m") > 0) & (rest_m > 0) & (z < APART)
        several = open_kid & (F.col("kids") > 1)
        to = F.when(several & alike, MERGED)
        told = kids.join(node, ["host", "template"]).select("host", "template", "child", to.alias("to"), (F.col("all_paths") == 1).alias("alone"))
        step = here.join(told.where("to is not null or alone"), ["host", "template", "child"], "left")
        seen = F.concat("template", F.lit("/"), F.coalesce("to", "child"))
        # A path alone in its node keeps the rest of its segments as they are.
        rest = F.concat(F.col("template"), F.lit("/"), F.array_join(F.slice("segments", F.col("depth") + 1, F.size("segments")), "/"))
        live = step.select(
            "host", "path", "n", "blocked", "labelled", "segments", F.when(F.col("alone"), rest).otherwise(seen).alias("template"), F.when(F.col("alone"), F.size("segments")).otherwise(F.col("depth") + 1).alias("depth")
        )
    return reduce(DataFrame.union, done).drop("depth", "segments")


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: ``id, host, path, rule, verdict, template, purity``.

    ``rules`` are (allow or block, host, path). ``template`` and ``purity`` are
    those of the url's host and path, whether a rule fits or not; urls without a
    host or path have an empty template. Rows with a null id or
    url and repeated rows come back as they are. Without any labelled url
    all purities are the prior and every url is allowed.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    mask = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, VARIABLE, "*"))
    rows = written(rows.withColumn("path_key", F.concat_ws("/", mask)), "urls")
    counts = rows.groupBy("host", F.col("path_key").alias("path")).agg(F.count("*").alias("n"), F.count_if(F.col("said") == "block").alias("blocked"), F.count("said").alias("labelled"))
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split("path", "/"))
    tree = written(_grow(counts.withColumn("segments", segments)), "templates")
    drawn = lambda to: (F.sum("blocked") + to * STRENGTH) / (F.sum("labelled") + STRENGTH)
    own = tree.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    over_hosts = own.where(~F.contains("template", F.lit(MERGED))).groupBy("template").agg(drawn(F.lit(PRIOR)).alias("prior"))
    prior = F.coalesce("prior", F.lit(PRIOR))
    leaves = own.join(over_hosts, "template", "left").select("host", "template", ((F.col("blocked") + prior * STRENGTH) / (F.col("labelled") + STRENGTH)).alias("purity"))
    known = written(tree.select("host", F.col("path").alias("path_key"), "template").join(leaves, ["host", "template"]), "purity")
    out = rows.join(known, ["host", "path_key"], "left")
    verdict = F.coalesce("said", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return out.select("id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
