"""URL filter: fixed host and path rules, and for the other URLs a
path-template tree per host.  DataFrame operations only.

Tree: a segment that holds nothing but an identifier (digits, a long
hexadecimal string, a date; an extension may follow) becomes a wildcard by
its form.  Then, level by level and per host and parent (as generalised so far, so
that what lies below a wildcard is pooled), children are variable too and
become one wildcard if there are many, evenly spread (by the entropy of their
shares of the distinct forms) and at least as many as a child has forms below
it on average.  Copies of an URL don't matter.  Branches with
labels, however few, that have the same shape under a host, i.e. differ only
in literal segments, are put in order of their share of rejected labels;
neighbours whose shares don't differ significantly are merged.  A merged
branch is rejected if its purity, the share of rejected labels smoothed by the
overall share, is high enough.  A branch without labels takes the share of its
shape under the host, smoothed by the host's; only known verdicts count there,
because a rule for a path says nothing of the paths beside it.  An URL without
labelled company on its host is allowed.

Everything after the parsing works on the table of distinct (host, template)
with counts, which partial aggregation makes before the shuffle, so a host
with a third of all URLs costs its distinct templates.  Templates whose shares
agree to a thousandth don't differ and are added up first: what is put in
order is at most ``SHARES`` + 1 rows for each host and shape.

Defined results: a null URL, or one without "://", has an empty host and
path and no rule; ties between rules of one length go to the smaller text;
repeated rows are judged alike; null ids stay; an empty table gives an empty
result; extra columns are ignored."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deidlake.llm.common import stored

BLOCK, ALLOW = "block", "allow"
#: Fixed rules of the data contract.
RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))

#: Children of a node from which it counts as variable if evenly spread.
MANY_CHILDREN = 30
#: Weight of the overall share in a branch's purity, and what rejects it.
PRIOR_WEIGHT = 5.0
REJECT_PURITY = 0.8
#: Shares are told apart to one part in so many.
SHARES = 1000
#: Standard normal quantile up to which two shares don't differ.
Z_SAME = 1.96

#: A segment that is an identifier by its form, with an optional extension.
IDENTIFIER = r"^([0-9]+|[0-9a-fA-F]*[0-9][0-9a-fA-F-]{7,}|[0-9]{4}-[0-9]{2}(-[0-9]{2})?)(\.[A-Za-z0-9]{1,5})?$"


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty without it."""
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def form(path: Column) -> Column:
    """Segments of a path, identifiers as "*"."""
    return F.transform(
        F.split(F.regexp_replace(path, "^/", ""), "/"),
        lambda s: F.when(s.rlike(IDENTIFIER), F.lit("*")).otherwise(s))


def templates(urls: DataFrame) -> DataFrame:
    """(host, segments, template, n, labels, rejected) of urls (host, path,
    label), ``label`` being 1 (reject), 0 or null: ``segments`` as ``form``
    gives them, ``template`` with the variable ones as wildcards too.  Of the
    labels, ``known`` (``label`` if there is no such column) count in
    ``known_labels`` and ``known_rejected``."""
    known = F.col("known" if "known" in urls.columns else "label")
    seen = urls.groupBy("host", form(F.col("path")).alias("segments")).agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labels"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("rejected"), F.count(known).alias("known_labels"),
        F.coalesce(F.sum(known), F.lit(0)).alias("known_rejected"))
    seen = stored(seen, "url-forms")  # read several times
    named = seen.withColumn("template", F.col("segments"))
    for depth in range(_levels(seen)):
        # the parent as generalised so far, so children below a wildcard are pooled
        parent, segment = F.slice("template", 1, depth), F.get("template", F.lit(depth))
        nodes = named.where(F.size("template") > depth).select("host", parent.alias("parent"), segment.alias("segment"))
        children = nodes.groupBy("host", "parent", "segment").agg(F.count(F.lit(1)).cast("double").alias("n"))
        total, several = F.sum("n"), F.count(F.lit(1))
        even = F.exp(F.log(total) - F.sum(F.col("n") * F.log("n")) / total)  # children that count, by entropy
        variable = children.groupBy("host", "parent").agg(several.alias("children"), (even * several / total).alias("per"), even.alias("even"))
        variable = variable.where((F.col("children") >= MANY_CHILDREN) & (2 * F.col("even") > F.col("children")) & (F.col("per") >= 1))
        marked = variable.select("host", F.col("parent").alias("__parent"), F.lit(True).alias("is_variable"))
        one = F.transform("template", lambda s, k: F.when(k == depth, F.lit("*")).otherwise(s))
        named = named.withColumn("__parent", parent).join(marked, ["host", "__parent"], "left").withColumn(
            "template", F.when(F.col("is_variable") & (F.size("template") > depth), one).otherwise(F.col("template")))
        named = stored(named.select(*seen.columns, "template"), "url-levels")
    return named


def _levels(seen: DataFrame) -> int:
    """Depth below which no host has enough forms for a variable segment."""
    sizes = seen.groupBy("host", F.size("segments").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    deeper = Window.partitionBy("host").orderBy(F.col("size").desc())
    sizes = sizes.withColumn("deeper", F.sum("n").over(deeper)).where(F.col("deeper") >= MANY_CHILDREN)
    return sizes.agg(F.max("size")).first()[0] or 0


def _share(counts: DataFrame) -> Column:
    """Share of rejected labels; 0 if there are no labels."""
    share = F.try_divide(F.sum("rejected").cast("double"), F.sum("labels").cast("double"))
    return counts.agg(F.coalesce(share, F.lit(0.0)).alias("prior")).scalar()


def branches(tree: DataFrame) -> DataFrame:
    """(host, template, purity, labels) of the templates with labels, after
    merging: ``purity`` and ``labels`` are those of the merged branch."""
    leaves = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("labels", "rejected")])
    prior = _share(leaves)
    share = F.round(SHARES * F.col("rejected") / F.col("labels")).cast("int")
    leaves = leaves.where(F.col("labels") > 0).select(
        "host", "template", "labels", "rejected", F.transform("template", lambda s: s == "*").alias("shape"), share.alias("share"))
    levels = leaves.groupBy("host", "shape", "share").agg(*[F.sum(c).alias(c) for c in ("labels", "rejected")])
    siblings = Window.partitionBy("host", "shape").orderBy("share")
    before = {c: F.lag(c).over(siblings) for c in ("labels", "rejected")}
    pooled = (F.col("rejected") + before["rejected"]) / (F.col("labels") + before["labels"])
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labels") + 1 / before["labels"]))
    apart = F.col("rejected") / F.col("labels") - before["rejected"] / before["labels"]
    opens = F.when(apart <= Z_SAME * error, 0).otherwise(1)
    merged = levels.withColumn("opens", opens).withColumn("branch", F.sum("opens").over(siblings))
    whole = Window.partitionBy("host", "shape", "branch")
    merged = merged.withColumns({c: F.sum(c).over(whole) for c in ("labels", "rejected")})
    purity = (F.col("rejected") + PRIOR_WEIGHT * prior) / (F.col("labels") + PRIOR_WEIGHT)
    merged = merged.select("host", "shape", "share", purity.alias("purity"), "labels")
    return leaves.select("host", "template", "shape", "share").join(merged, ["host", "shape", "share"]).select(
        "host", "template", "purity", "labels")


def unlabelled(tree: DataFrame) -> DataFrame:
    """(host, template, purity) of the templates without labels on hosts with
    known ones: the share of the branches of the same shape under the host,
    smoothed by the host's, which is smoothed by the overall one."""
    counts = tree.groupBy("host", F.transform("template", lambda s: s == "*").alias("shape")).agg(
        F.sum("known_labels").alias("labels"), F.sum("known_rejected").alias("rejected"))
    prior = _share(tree)
    smooth = lambda above: (F.col("rejected") + PRIOR_WEIGHT * above) / (F.col("labels") + PRIOR_WEIGHT)
    hosts = counts.groupBy("host").agg(F.sum("labels").alias("labels"), F.sum("rejected").alias("rejected"))
    hosts = hosts.where(F.col("labels") > 0).select("host", smooth(prior).alias("of_host"))
    shapes = counts.join(hosts, "host").select("host", "shape", smooth(F.col("of_host")).alias("purity"))
    leaves = tree.groupBy("host", "template").agg(F.sum("labels").alias("labels")).where(F.col("labels") == 0)
    leaves = leaves.withColumn("shape", F.transform("template", lambda s: s == "*"))
    return leaves.join(shapes, ["host", "shape"]).select("host", "template", "purity")


def rejected_paths(urls: DataFrame) -> DataFrame:
    """(host, segments) of the forms whose branch is rejected."""
    tree = stored(templates(urls), "url-templates")
    judged = branches(tree).select("host", "template", "purity").unionByName(unlabelled(tree))
    bad = judged.where(F.col("purity") >= REJECT_PURITY)
    return tree.join(bad.select("host", "template"), ["host", "template"], "left_semi").select("host", "segments")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          label: Column | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict).  ``label``: known verdicts as 1
    (reject), 0 or null, an expression over the columns of ``pages``; without
    it the URLs that the rules decide are the labelled ones."""
    url = F.col(f"`{url_col}`").cast("string")
    parsed = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        (F.lit(None) if label is None else label).cast("int").alias("known"))
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    decided = F.lit(None).cast("string")
    for text, verdict in rules:
        decided = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(decided)
    parsed = parsed.withColumn("decided", decided)
    labelled = parsed.select("host", "path", F.coalesce(
        F.col("known"), F.when(F.col("decided") == BLOCK, 1).when(F.col("decided") == ALLOW, 0)).alias("label"), "known")
    bad = rejected_paths(labelled).withColumn("bad", F.lit(True))
    out = parsed.withColumn("segments", form(F.col("path"))).join(bad, ["host", "segments"], "left")
    verdict = F.coalesce("decided", F.when(F.col("bad"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
